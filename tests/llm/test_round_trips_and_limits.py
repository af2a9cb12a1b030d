"""Pseudonyms that never meet, pages with unclosed elements, repeated queries, limits of boilerplate lines."""

import time

from pyspark.sql import functions as F

from tableload.llm import html_main, onebit_ann, pii, quality_rules

from .test_text_operators import documents


def test_telephone_numbers_are_permuted(spark):
    texts = [f"+44 {a:03d} {b:03d} 12" for a in range(0, 1000, 7) for b in range(0, 1000, 9)]
    df = documents(spark, texts)
    got = pii.pseudonymise(df, "secret").agg(F.count_distinct("text"), F.count_if(F.col("n_replaced") == 1),
                                             F.count_if(F.col("text").rlike("^\\+44 [0-9]{3} [0-9]{3} [0-9]{2}$"))).first()
    assert tuple(got) == (len(texts),) * 3
    # what a number may become is closed: dialable first digits stay so, others too
    same = pii.pseudonymise(df, "secret").where(
        F.col("text").substr(5, 1).rlike("[2-9]") != F.col("_row.text").substr(5, 1).rlike("[2-9]"))
    assert same.count() == 0


def test_long_secrets_take_linear_time(spark):
    def seconds(n):
        df = documents(spark, ["token=" + "0123456789abcdef" * (n // 16)]).coalesce(1)
        start = time.time()
        (r,) = pii.pseudonymise(df, "secret").collect()
        assert len(r["text"]) == 6 + n and r["text"] != r["_row"]["text"] and r["n_replaced"] == 1
        return time.time() - start
    seconds(1600)
    assert seconds(64000) < 6 * seconds(16000) + 5


def test_unclosed_elements_keep_the_rest_of_the_page(spark):
    page = ("<html><body><nav><a href=/>Home</a></nav><article><p>" + "First words of the article stand here. " * 4 + "</p>{}<p>"
            + "The rest of the article follows after it. " * 4 + "</p></article></body></html>")
    tags = ["<video src=x>", "<audio>", "<svg><path d=z>", "<canvas>", "<object data=y>", "<template>", "<math><mi>x</mi>"]
    df = spark.createDataFrame([(i, "http://h.example/a", page.format(t)) for i, t in enumerate(tags)], "page_id long, url string, html string")
    for r in html_main.main_text(df).collect():
        assert "First words" in r["text"] and "follows after" in r["text"], tags[r["page_id"]]
    closed = spark.createDataFrame([(0, "http://h.example/a", page.format("<svg><text>drawn</text></svg><script>var a</script>"))], df.schema)
    assert "drawn" not in html_main.main_text(closed).first()["text"] and "var a" not in html_main.main_text(closed).first()["text"]


def test_a_repeated_query_has_one_list(spark):
    rows = [(i, [float(i % 13), float(i % 7), 1.0]) for i in range(120)]
    df = spark.createDataFrame(rows + rows[:1] * 3 + [(0, [9.0, 9.0, 9.0])], "vec_id long, embedding array<double>")
    index, parameters = onebit_ann.build_index(df)
    got = onebit_ann.search(index, parameters, index.where("vec_id = 0"), k=5).orderBy("rank").collect()
    assert [r["rank"] for r in got] == [1, 2, 3, 4, 5] and len({r["vec_id"] for r in got}) == 5


def test_the_limit_of_a_line_stops_growing_with_its_host(spark):
    body = " ".join(f"w{i}" for i in range(30))
    texts = [f"text {i} {body}\nShared footer" + ("\nRare footer" if i % 20 == 0 else "") for i in range(400)]
    df = documents(spark, texts, sources=("s",))
    counts = quality_rules.line_counts(df)
    hashes = {n: quality_rules.line_hash(F.lit(n)) for n in ("Shared footer", "Rare footer")}
    named = lambda **limits: {n for n, h in hashes.items() if quality_rules.frequent_lines(counts, 15, **limits)
                              .where(F.col("line") == h).count()}
    assert named() == {"Shared footer"}                           # 20 of 400 texts are under a tenth
    assert named(max_docs=19) == {"Shared footer", "Rare footer"}
    assert named(max_docs=20) == {"Shared footer"}
    assert named(max_share=0.01, max_docs=10 ** 6) == {"Shared footer", "Rare footer"}
