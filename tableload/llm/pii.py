"""Format-preserving pseudonyms for personal data.

Numbers, dates and names of accounts are found by one pattern, validated by kind (check
digits, ranges, calendar), and replaced by a keyed permutation of all values of the same
format: a Feistel network whose halves are vectors of symbols, each added to modulo the size
of its alphabet.  The replacement is of the same kind and valid again; equal values get equal
pseudonyms in every document, and different values of one format never meet.  Whoever holds
the key can undo it.  Built-in functions only.

Kinds: e-mail address, access key, password or token, international bank account number
(ISO 7064 check digits), card number (Luhn), social security number, telephone number, IPv4
address, calendar date.  What fails its validation stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
ACCESS_KEY = r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])"
SECRET = r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api_?key)[ \t]{0,4}[=:][ \t]{0,4}[\"']?[A-Za-z0-9+/_.-]{8,}+[\"']?"
#: length of an account number by country
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
                22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
                25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
                29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
# the known length first, so that a word or number after the account number is not taken in
IBAN = "(?<![A-Za-z0-9])(?:" + "|".join(
    f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    + "(?![A-Za-z0-9])" for n, countries in IBAN_LENGTHS.items()) \
    + "|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
# a time may follow an ISO date
ISO_DATE = r"(?<![0-9A-Za-z./-])[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:(?=[Tt][0-9]{2})|(?![0-9A-Za-z/-]|\.[0-9]))"
DATE = r"(?<![0-9A-Za-z./-])(?:[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2})(?![0-9A-Za-z/-]|\.[0-9])"
IPV4 = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
#: a value of its own after a space, which a number before the space does not take in
OTHER = (r"(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?![0-9]|-[0-9])|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}(?![0-9])|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}(?![0-9])"
         r"|[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])|[2-9][0-9]{2}-[2-9][0-9]{2}-[0-9]{4}(?![0-9]|-[0-9]))")
_CARD_LAYOUT = r"[0-9]{4}[ -](?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{6}[ -][0-9]{4,5})(?![0-9])"
PHONE = (r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,5}\)[ .-]?)?[0-9]{2,5}"
         rf"(?:(?:[.-]| (?!{OTHER}|{_CARD_LAYOUT}))?[0-9]{{2,5}}){{1,4}}(?![0-9A-Za-z])"
         r"|(?<![0-9A-Za-z(])\([2-9][0-9]{2}\) ?[2-9][0-9]{2}-[0-9]{4}(?![0-9A-Za-z])"
         r"|(?<![0-9A-Za-z.-])[2-9][0-9]{2}[.-][2-9][0-9]{2}[.-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])")
#: digits of an international number by country code, where the numbering plan has one length
PHONE_LENGTHS = {"45|47": 10, "1|7|31|33|34|41|48|61": 11, "30|44|91": 12}
SSN = r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"
_GROUP = r"[0-9]++(?![A-Za-z]|\.[0-9])"
# a whole run of digit groups; the card numbers in it are found by ``_cards``
CARD = rf"(?<![0-9A-Za-z.-])(?=(?:[0-9][ -]?){{12}}[0-9]){_GROUP}(?:(?:-| (?!{OTHER})){_GROUP})*+(?!-[0-9])"
ANY = "|".join((EMAIL, ACCESS_KEY, SECRET, IBAN, ISO_DATE, DATE, IPV4, SSN, PHONE, CARD))
#: without one of these there is nothing to find
MAYBE = r"[0-9@]|(?i:pass|pwd|secret|token|key)|A[KS]IA"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def feistel(symbols: Column, radixes: Column, key: Column) -> Column:
    """Keyed permutation of symbol vectors: ``symbols[i]`` in 0 .. ``radixes[i]`` - 1 (ints, 128 at most)."""
    half = F.size(symbols).cast("int") / 2
    cut = F.floor(half).cast("int")

    def add(part: Column, radix: Column, other: Column, turn: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", key, turn.cast("string"), F.concat_ws(",", other.cast("array<string>"))), 512)
        return _let(digest, lambda d: F.zip_with(
            F.transform(part, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), radix,
            lambda p, r: F.pmod(p["x"] + F.conv(F.substring(d, 1 + (p["i"] % 21) * 6, F.lit(6)), 16, 10).cast("long"), r).cast("int")))
    left, right = F.slice(symbols, F.lit(1), cut), F.slice(symbols, cut + 1, F.size(symbols))
    left_radix, right_radix = F.slice(radixes, F.lit(1), cut), F.slice(radixes, cut + 1, F.size(symbols))
    state = F.struct(left.cast("array<int>").alias("a"), right.cast("array<int>").alias("b"))

    def turn(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(add(s["a"], left_radix, s["b"], i).alias("a"), s["b"].alias("b"))) \
            .otherwise(F.struct(s["a"].alias("a"), add(s["b"], right_radix, s["a"], i).alias("b")))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state, turn, lambda s: F.concat(s["a"], s["b"]))


def _permute_text(text: Column, alphabet, key: Column) -> Column:
    """Permute the characters of a text; ``alphabet(char, position)`` gives the letters a
    character may become, or '' to keep it."""
    chars = F.transform(F.split(text, ""), lambda c, i: F.struct(c.alias("c"), alphabet(c, i).alias("abc"), i.alias("i")))

    def rebuilt(cs: Column) -> Column:
        free = F.filter(cs, lambda x: x["abc"] != "")
        mixed = feistel(F.transform(free, lambda x: F.instr(x["abc"], x["c"]) - 1),
                        F.transform(free, lambda x: F.length(x["abc"])), key)
        places = F.transform(free, lambda x: x["i"])
        return _let(F.struct(mixed.alias("m"), places.alias("p")), lambda s: F.array_join(F.transform(cs, lambda x: F.when(
            x["abc"] == "", x["c"]).otherwise(F.substring(x["abc"], F.get(s["m"], (F.array_position(s["p"], x["i"]) - 1).cast("int")) + 1,
                                                          F.lit(1)))), ""))
    return _let(chars, rebuilt)


def _permute_long(text: Column, alphabet, key: Column) -> Column:
    """``_permute_text`` in time linear in the length: kept characters take part with radix 1."""
    chars = F.transform(F.split(text, ""), lambda c, i: F.struct(c.alias("c"), alphabet(c, i).alias("abc")))

    def rebuilt(cs: Column) -> Column:
        mixed = feistel(F.transform(cs, lambda x: F.when(x["abc"] == "", 0).otherwise(F.instr(x["abc"], x["c"]) - 1)),
                        F.transform(cs, lambda x: F.greatest(F.length(x["abc"]), F.lit(1))), key)
        return F.array_join(F.zip_with(cs, mixed, lambda x, m: F.when(x["abc"] == "", x["c"])
                                       .otherwise(F.substring(x["abc"], m + 1, F.lit(1)))), "")
    return _let(chars, rebuilt)


def _by_class(c: Column) -> Column:
    return F.when(c.rlike("[0-9]"), DIGITS).when(c.rlike("[a-z]"), LOWER).when(c.rlike("[A-Z]"), UPPER).otherwise("")


def _digit(c: Column) -> Column:
    return F.when(c.rlike("[0-9]"), DIGITS).otherwise("")


def _luhn_rest(digits: Column, check: bool) -> Column:
    """Luhn sum modulo 10; ``check``: the last digit is the check digit."""
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda d, i: _let(
        d.cast("int") * F.when(i % 2 == (1 if check else 0), 2).otherwise(1), lambda x: x - F.when(x > 9, 9).otherwise(0))),
        F.lit(0), lambda acc, x: acc + x) % 10


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _card(m: Column, key: Column) -> Column:
    body = _permute_text(F.regexp_replace(m, "[0-9]$", ""), lambda c, i: _digit(c), key)
    return _let(body, lambda b: F.concat(b, ((10 - _luhn_rest(_only_digits(b), False)) % 10).cast("string")))


def _is_card(text: Column) -> Column:
    return _let(_only_digits(text), lambda d: F.when(F.length(d).between(13, 19), _luhn_rest(d, True) == 0).otherwise(False))


def _cards(run: Column, key: Column) -> Column:
    """(text, n) of a run of digit groups with the card numbers in it replaced; n is their number.

    A card number is a part of the run between group borders, 13 to 19 digits, of valid check
    digit, in groups of four or more (the last may be shorter); the shortest counts, so that a
    security code, an expiry or a year after it is not taken in.  One that starts like a
    network's number goes before one that overlaps it and does not.  A run without one may be
    a number as a whole, in any groups.
    """
    def replaced(parts: Column) -> Column:
        part = lambda i, n: F.regexp_replace(F.array_join(F.slice(parts, i + 1, n), ""), "[ -]$", "")

        def best(first: Column, i: Column) -> Column:
            lengths = F.filter(F.sequence(F.lit(1), F.least(F.lit(5), F.size(parts) - i)), lambda n: part(i, n).rlike(
                "^(?:[0-9]{4,}[ -])*[0-9]+$") & _is_card(part(i, n)))
            return F.when(first.rlike("^[0-9]{4}"), F.struct(F.get(lengths, F.lit(0)).alias("n"),
                                                             first.rlike("^(?:[3-6]|2[2-7])").alias("network")))

        def walk(found: Column) -> Column:
            def step(s: Column, i: Column) -> Column:
                n = F.get(found, i)["n"]
                weaker = ~F.get(found, i)["network"] & F.exists(F.slice(found, i + 2, F.greatest(n - 1, F.lit(0))),
                                                               lambda x: F.coalesce(x["network"] & x["n"].isNotNull(), F.lit(False)))
                taken = F.coalesce(n.isNotNull() & ~weaker, F.lit(False))
                rest = lambda at: F.regexp_extract(F.get(parts, at), "[ -]$", 0)
                return F.when(i < s["until"], s).when(taken, F.struct(
                    F.concat(s["text"], _card(part(i, n), key), rest(i + n - 1)).alias("text"), (s["n"] + 1).alias("n"),
                    (i + n).alias("until"))) \
                    .otherwise(F.struct(F.concat(s["text"], F.get(parts, i)).alias("text"), s["n"].alias("n"), (i + 1).alias("until")))
            start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"), F.lit(0).alias("until"))
            return F.aggregate(F.sequence(F.lit(0), F.size(parts) - 1), start, step)
        return _let(F.transform(parts, best), walk)
    inner = _let(F.regexp_extract_all(run, F.lit("[0-9]+[ -]?"), F.lit(0)), replaced)
    return _let(inner, lambda x: F.when(x["n"] > 0, F.struct(x["text"].alias("text"), x["n"].alias("n")))
                .when(_is_card(run), F.struct(_card(run, key).alias("text"), F.lit(1).alias("n")))
                .otherwise(F.struct(F.lit(None).cast("string").alias("text"), F.lit(0).alias("n"))))


def _mod97(text: Column) -> Column:
    """Letters as 10 .. 35, the whole as a number modulo 97."""
    values = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(DIGITS + UPPER), c) - 1)
    return F.aggregate(values, F.lit(0), lambda acc, v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _iban_valid(m: Column) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    return (F.length(plain).between(15, 34)) & (_mod97(F.concat(F.substring(plain, F.lit(5), F.lit(40)), F.substring(plain, 1, 4))) == 1)


def _iban(m: Column, key: Column) -> Column:
    mixed = _permute_text(m, lambda c, i: F.when(i < 4, "").when(c.rlike("[0-9]"), DIGITS).when(c.rlike("[A-Z]"), UPPER).otherwise(""), key)

    def checked(b: Column) -> Column:
        plain = F.replace(b, F.lit(" "), F.lit(""))
        rest = _mod97(F.concat(F.substring(plain, F.lit(5), F.lit(40)), F.substring(plain, 1, 2), F.lit("00")))
        return F.concat(F.substring(b, 1, 2), F.lpad((98 - rest).cast("string"), 2, "0"), F.substring(b, F.lit(5), F.lit(60)))
    return _let(mixed, checked)


def _ip(m: Column, key: Column) -> Column:
    octets = F.transform(F.split(m, "\\."), lambda x: x.cast("int"))
    return F.array_join(F.transform(feistel(octets, F.array_repeat(F.lit(256), 4), key), lambda x: x.cast("string")), ".")


#: days of the Gregorian cycle of 400 years, 146,097 = 189 x 773: the permuted calendar
_CYCLE_START, _A, _B = "1800-01-01", 189, 773


def _date(day: Column, key: Column) -> Column:
    at = F.datediff(day, F.lit(_CYCLE_START).cast("date"))
    pair = F.array(F.floor(at / _B).cast("int"), F.pmod(at, F.lit(_B)).cast("int"))
    return _let(feistel(pair, F.array(F.lit(_A), F.lit(_B)), key),
                lambda p: F.date_add(F.lit(_CYCLE_START).cast("date"), F.get(p, F.lit(0)) * _B + F.get(p, F.lit(1))))


def _in_cycle(day: Column) -> Column:
    return day.between(F.lit(_CYCLE_START).cast("date"), F.lit("2199-12-31").cast("date"))


def _ssn_alphabet(c: Column, i: Column) -> Column:
    # the first digit keeps numbers valid: areas that begin with 0, 6 or 9 keep it
    return F.when((i == 0) & c.rlike("[069]"), "").when(i == 0, "1234578").otherwise(_digit(c))


def _phone(m: Column, key: Column) -> Column:
    # the country code stays; a group's first digit stays dialable (2 to 9) or not (0 and 1), so that
    # the numbers of one such form are permuted among themselves and no two of them meet
    open_at = F.when(m.startswith("+"), F.length(F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])|^\+[0-9]", 0))).otherwise(0)
    first = lambda i: F.substring(m, i, F.lit(1)).rlike("[ .(+-]")  # noqa: E731 - the character before position i
    return _permute_text(m, lambda c, i: F.when(i < open_at, "").when(~c.rlike("[0-9]"), "")
                         .when((i == 0) | first(i), F.when(c.rlike("[2-9]"), "23456789").otherwise("01")).otherwise(DIGITS), key)


def _phone_within(m: Column, key: Column) -> Column:
    """The number at the start of ``m`` replaced: up to the group border that its country's length
    names, or else the last one within 15 digits; null if there is none from 7 digits on."""
    heads = lambda parts: F.filter(F.transform(
        parts, lambda p, i: F.array_join(F.slice(parts, F.lit(1), i + 1), "")),
        lambda h: F.length(_only_digits(h)).between(7, 15))

    def replaced(found: Column) -> Column:
        named = F.filter(found, lambda h: F.exists(
            F.array(*[F.struct(F.lit(f"^\\+(?:{c})").alias("code"), F.lit(n).alias("n")) for c, n in PHONE_LENGTHS.items()]),
            lambda x: F.regexp_like(h, x["code"]) & (F.length(_only_digits(h)) == x["n"])))
        return _let(F.coalesce(F.get(named, F.lit(0)), F.get(found, F.size(found) - 1)),
                    lambda h: F.concat(_phone(h, key), F.substring(m, F.length(h) + 1, F.length(m))))
    return _let(F.regexp_extract_all(m, F.lit("[^0-9]*[0-9]+"), F.lit(0)), lambda parts: _let(heads(parts), replaced))


def pseudonym(m: Column, key: Column) -> Column:
    """(text, n): the match with the values in it replaced, null if none passes the validation of
    its kind, and their number."""
    k = lambda kind: F.concat_ws("|", key, F.lit(kind))
    whole = lambda p: m.rlike(f"^(?:{p})$")
    # two digits for day and month, or as many as they have
    dates = [(f"^{form}$".replace("D", "[0-9]{2}" if padded else "[0-9]{1,2}"), parse if padded else parse.replace("dd", "d").replace("MM", "M"))
             for padded in (True, False) for form, parse in ((r"[0-9]{4}-D-D", "yyyy-MM-dd"), (r"D\.D\.[0-9]{4}", "dd.MM.yyyy"),
                                                             (r"D/D/[0-9]{4}", "MM/dd/yyyy"), (r"D/D/[0-9]{4}", "dd/MM/yyyy"),
                                                             (r"[0-9]{4}/D/D", "yyyy/MM/dd"))]
    as_date = F.coalesce(*[F.when(m.rlike(form), _let(F.try_to_date(m, parse), lambda day: F.when(
        _in_cycle(day), F.date_format(_date(day, k("date")), parse)))) for form, parse in dates])
    prefix = F.regexp_extract(m, "^[^=:]*[=:][ \\t]*[\"']?", 0)
    value = F.substring(m, F.length(prefix) + 1, F.length(m))
    at = F.instr(m, "@")
    domain_end = F.length(m) - F.length(F.substring_index(m, ".", -1)) - 1
    email = _permute_text(m, lambda c, i: F.when((i == at - 1) | (i >= domain_end), "").otherwise(_by_class(c)), k("email"))
    hexadecimal = value.rlike("^[0-9a-f]+[\"']?$")
    in_hex = lambda c: F.when(c.rlike("[0-9a-f]"), HEX).otherwise("")
    # whether the whole value is hexadecimal is found once, not at every character
    secret = F.concat(prefix, _let(hexadecimal, lambda hexed: F.when(F.length(value) > 128, _permute_long(
        value, lambda c, i: F.when(hexed, in_hex(c)).otherwise(_by_class(c)), k("secret")))
        .when(hexed, _permute_text(value, lambda c, i: in_hex(c), k("secret")))
        .otherwise(_permute_text(value, lambda c, i: _by_class(c), k("secret")))))
    as_phone = F.when(F.length(_only_digits(m)).between(7, 15), _phone(m, k("phone")))
    single = F.when(F.instr(m, "@") > 0, email) \
        .when(whole(ACCESS_KEY), _permute_text(m, lambda c, i: F.when(i < 4, "").otherwise(DIGITS + UPPER), k("access"))) \
        .when(whole(SECRET), secret) \
        .when(whole(IBAN), F.when(_iban_valid(m), _iban(m, k("iban")))) \
        .when(m.rlike("^(?:[0-9]{4}([/-])[0-9]{1,2}\\1[0-9]{1,2}|[0-9]{1,2}([./])[0-9]{1,2}\\2[0-9]{4})$"), as_date) \
        .when(whole(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"), F.when(
            ~F.exists(F.split(m, "\\."), lambda x: x.cast("int") > 255), _ip(m, k("ip")))) \
        .when(whole("[0-9]{3}-[0-9]{2}-[0-9]{4}"), F.when(
            ~m.rlike("^(?:000|666|9)|-00-|-0000$"), _permute_text(m, _ssn_alphabet, k("ssn")))) \
        .when(m.startswith("+"), _phone_within(m, k("phone"))) \
        .when(whole(PHONE), as_phone)
    as_one = _let(single, lambda p: F.struct(p.alias("text"), F.when(p.isNotNull(), 1).otherwise(0).alias("n")))
    return F.when(m.rlike("^[0-9](?:[ -]?[0-9]){12}[0-9 -]*+$"), _cards(m, k("card"))).otherwise(as_one)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Each row (struct ``_row`` of all its columns) with ``text``, its text with personal data
    replaced, and ``n_replaced`` (long).

    A null text stays null, an empty one empty; texts without findings come back unchanged;
    repeated rows get equal results; input columns live in ``_row`` and cannot clash.
    Nothing is shuffled.
    """
    if not key:
        raise ValueError("a key is needed")
    raw = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_col).alias("_text"))
    none = F.array().cast("array<string>")
    found = raw.withColumn("_found", F.when(F.col("_text").rlike(MAYBE), F.regexp_extract_all("_text", F.lit(ANY), F.lit(0))).otherwise(none))
    named = found.withColumn("_names", F.transform("_found", lambda m: pseudonym(m, F.lit(key))))
    pieces = F.split("_text", ANY, -1)
    joined = F.array_join(F.flatten(F.zip_with(pieces, F.zip_with(
        "_found", "_names", lambda m, p: F.coalesce(p["text"], m)), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    count = F.aggregate("_names", F.lit(0).cast("long"), lambda n, x: n + x["n"])
    done = named.withColumn("n_replaced", F.coalesce(count, F.lit(0).cast("long")))
    return done.select("_row", F.when(F.col("n_replaced") > 0, joined).otherwise(F.col("_text")).alias("text"), "n_replaced")
