"""Golden rows of the expressions."""

from pyspark.sql import functions as F

from newsloom.functions import names, responses, text, urls


def one(spark, column, **values):
    row = spark.range(1)
    for k, v in values.items():
        row = row.withColumn(k, F.lit(v).cast("string") if v is None else F.lit(v))
    return row.select(column.alias("x")).first()["x"]


def test_urls(spark):
    c = F.col("u")
    assert one(spark, urls.canonical_url(c), u="HTTPS://Example.com:443/a//b/?utm_source=x&b=2&a=1&fbclid=abc#top") == "https://example.com/a/b?a=1&b=2"
    assert one(spark, urls.canonical_url(c), u="//example.com") == "https://example.com/"
    assert one(spark, urls.canonical_url(c), u="https://example.com:99999/a") is None
    assert one(spark, urls.canonical_url(c), u="nothing") is None
    assert one(spark, urls.source_domain(c), u="https://www.bbc.co.uk/news/article-123") == "bbc.co.uk"


def test_dates(spark):
    c = text.parse_published(F.col("d"))
    assert one(spark, text.iso_utc(c["ts"]), d="Thu, 18 Jan 2024 09:30:00 GMT") == "2024-01-18T09:30:00Z"
    assert one(spark, text.iso_utc(c["ts"]), d="2024-01-18T11:22:00Z") == "2024-01-18T11:22:00Z"
    assert one(spark, c["err"], d="not-a-date") is True


def test_names(spark):
    c = F.col("n")
    assert one(spark, names.normalize_name(c), n="John Smith (politician)") == "john smith"
    assert one(spark, names.normalize_name(c), n="José Ángel") == "jose angel"
    assert one(spark, names.normalize_name(c), n=None) == ""
    assert "Ada Lovelace" in one(spark, names.name_variants(c), n="Dr Ada Lovelace")
    assert "John Smith" in one(spark, names.name_variants(c), n="Smith, John")


def test_biography(spark):
    score = lambda *c: one(spark, text.biography_score(F.array(*map(F.lit, c))))
    assert score("Category:Living people", "1950 births") >= 3
    assert score("Lists of places", "Municipalities of X") < 0


def test_coverage_queries(spark):
    q = text.coverage_queries(F.col("n"), F.col("t"), F.lit(""))
    assert one(spark, q, n="Rose Freedman", t=None) == ['"Rose Freedman"']
    found = one(spark, q, n="Juan Jose Valdez", t="Last Marine dies")
    assert {'"Juan Jose Valdez" obituary', '"Juan Valdez"', "Juan Valdez", '"Juan Valdez" Last Marine'} <= set(found)


def test_original_source(spark):
    same = lambda d, s: one(spark, text.is_original_source(F.lit("a"), F.lit(d), F.lit("b"), F.lit(s)))
    assert same("bbc.com", "BBC News") and not same("reuters.com", "BBC News")


def test_rules(spark):
    rows = [("Ed Crane dies at 86", "", "PREFILTER_PASS_TO_LLM"), ("man died", "tributes paid", "PREFILTER_SKIP_NO_NAME"), ("weather forecast", "", "PREFILTER_SKIP_NO_NAME"), ("Letters: on rain", "", "LETTERS_HEADER_SKIP"), ("The week in pictures", "", "PREFILTER_SKIP_STRUCTURAL_PATTERN"), ("x", "My late husband, Ed Crane", "PERSONAL_TRIBUTE_OBIT_SKIP")]
    out = text.classify_event(spark.createDataFrame(rows, "entry_title string, summary string, want string"))
    assert all(r["prefilter_decision"] == r["want"] for r in out.collect())


def test_salvage(spark):
    r = responses.salvage_json(F.col("t"))
    assert one(spark, r["value"], t='Sure: {"a": 1} ok') == '{"a": 1}'
    assert one(spark, r["error"], t="") == "empty_output"
    assert one(spark, r["error"], t="none") == "no_json_object_found"
    assert one(spark, r["error"], t="{bad}") == "json_decode_error"
