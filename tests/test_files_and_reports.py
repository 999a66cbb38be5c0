import json
import re

from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.plans import kpis, reports
from opinara.plans.filters import Filters, apply_filters
from opinara.sources import files, pages, schemas, seeds


def test_csv_round_trip(spark, tmp_path):
    rows = [
        ("a", "n", " bords ", 'dit "oui", puis\nnon; \\ fin', 4.5, "2024-01-02"), ("é", None, None, "x", None, None),
        ("a", "n", "l", "ligne\r\nsuite", 0.0, "Unknown Date"),
    ]
    df = spark.createDataFrame(rows, schemas.REVIEWS_RAW)
    files.write_csv(df, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), schemas.REVIEWS_RAW)
    key = lambda r: str(r.review_text)
    got, expected = sorted(back.collect(), key=key), sorted(df.collect(), key=key)
    assert [g.asDict() for g in got if g.review_text[:5] != "ligne"] == [e.asDict() for e in expected if e.review_text[:5] != "ligne"]
    assert got[1].review_text.replace("\r\n", "\n") == "ligne\nsuite"


def test_csv_columns_by_name(spark, tmp_path):
    spark.createDataFrame([("3", "a", "x y"), ("NaN", "b", None)], "rating string, bank_name string, tokens string").write.options(
        **files.CSV_OPTIONS
    ).csv(str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), schemas.REVIEWS_CLEANED)
    rows = {r.bank_name: r for r in back.collect()}
    assert rows["a"].rating == 3.0 and rows["a"].tokens == ["x", "y"] and rows["b"].rating is None
    assert rows["a"].review_text is None and back.dtypes == spark.createDataFrame([], schemas.REVIEWS_CLEANED).dtypes


def test_kpi_json_and_lines(spark, tmp_path):
    row = spark.createDataFrame([(2, "Société")], "total_reviews long, best_bank string")
    files.write_kpis(row, str(tmp_path / "kpis"))
    (part,) = (tmp_path / "kpis").glob("part-*")
    assert json.loads(part.read_text(encoding="utf-8")) == {"total_reviews": 2, "best_bank": "Société"} and "Société" in part.read_text()
    lines = spark.createDataFrame([(n, f"l{n}") for n in (3, 1, 2)], "line_no long, value string")
    files.write_lines(lines, str(tmp_path / "lines"))
    (part,) = (tmp_path / "lines").glob("part-*")
    assert part.read_text() == "l1\nl2\nl3\n"


def test_newest_file(spark, tmp_path):
    assert files.run_path("out", "20250612_001641") == "out/run_ts=20250612_001641"
    for name in ("bank_reviews_sentiment_9.csv", "other_1.csv"):
        (tmp_path / name).write_text("a\n")
    assert files.newest_file(spark, str(tmp_path)).endswith("bank_reviews_sentiment_9.csv")
    (tmp_path / "bank_reviews_topics_1.csv").write_text("a\n")
    assert files.newest_file(spark, str(tmp_path)).endswith("bank_reviews_topics_1.csv")
    assert files.newest_file(spark, str(tmp_path), ("nothing_",)) is None


def test_crawl_queries(spark):
    found = seeds.crawl_queries(seeds.names(spark, fixed.BANKS, "bank_name")).collect()
    assert len(found) == 48 and ("BMCE Bank", "Fès", "BMCE+Bank+Fès") in [tuple(r) for r in found]


def test_review_pages(spark):
    html = """<h1 class="x DUwDvf">Agence A</h1><button data-item-id='address'>Rue 1</button>
      <div class="jftiEf z"><span aria-label="4 stars">s</span><span class="wiI7pd"> bon </span><span class="rsqaWe">il y a 2 mois</span></div>
      <div class="jftiEf z"><span class="wiI7pd"></span></div>
      <div class="jftiEf z"><span aria-label="2.5 stars">s</span></div>"""
    plain = '<h1>B</h1><div class="review"><span class="review-full-text">ok</span><span class="date">hier</span></div>'
    links = '<a href="https://www.google.com/maps/place/1">x</a><a href="https://www.google.com/maps/place/1">y</a><a href="/z">z</a>'
    df = spark.createDataFrame([(1, "b", html), (2, "b", plain), (3, "b", links)], "page_id long, bank_name string, html string")
    rows = [tuple(r)[1:] for r in pages.extract_reviews(df).orderBy("page_id", "position").collect()]
    assert rows == [
        (0, "b", "Agence A", "Rue 1", "bon", 4.0, "il y a 2 mois"), (2, "b", "Agence A", "Rue 1", "No text", 2.5, "Unknown Date"),
        (0, "b", "B", "Unknown Location", "ok", 0.0, "hier"),
    ]
    assert pages.extract_reviews(df, max_reviews=1).count() == 2
    found = pages.distinct_links(pages.links(df, "bank_name"), "bank_name")
    assert [r.url for r in found.collect()] == ["https://www.google.com/maps/place/1"]


def test_flat_and_simple_datasets_fill_missing_columns(spark):
    df = spark.createDataFrame([("a", "x"), (None, "y")], "bank_name string, rating string")
    flat = {r.bank_name: r for r in reports.flat_dataset(df).collect()}
    row = flat["Banque Inconnue"]
    assert (row.star_rating, row.sentiment_label, row.sentiment_score, row.topic_name, row.review_text, row.word_count) == (
        3.0, "neutral", 0.0, "autres", "Pas de texte", 3,
    )
    assert (str(row.review_date), row.month_name, row.rating_category) == ("2024-01-01", "January", "Moyen (3★)")
    simple = {r.Banque: r for r in reports.simple_dataset(df).collect()}
    row = simple["Banque Inconnue"]
    assert (row.Agence, row.Note, row.Longueur_Avis, row.Nb_Mots, row.Date, row.Mois) == ("Inconnue", 3.0, 100, 20, "2024-06-01", 6)


def test_publish_keeps_fractions_of_means(spark):
    df = spark.createDataFrame([(None, None, 3.456, 2.345, 7, "2024-01-02")],
                               "bank_name string, sentiment_label string, avg_word_count double, avg_score double, n_count int, review_date string")
    (row,) = reports.publish(df).collect()
    assert (row.bank_name, row.sentiment_label, row.avg_word_count, row.avg_score, str(row.review_date)) == (
        "Inconnu", "unknown", 3.46, 2.35, "2024-01-02",
    )
    assert reports.publish(df).schema["n_count"].dataType.typeName() == "long"


def test_filters(spark):
    rows = [(n, f"2024-0{n}-15", "a" if n % 2 else "b", float(n), "t" if n < 8 else None) for n in range(1, 10)]
    df = spark.createDataFrame(rows, "id int, d string, bank_name string, star_rating double, topic_name string")
    df = df.withColumn("review_date", F.to_date("d"))

    def ids(**chosen):
        return [r.id for r in apply_filters(df, Filters(**chosen), "2024-09-15").orderBy("id").collect()]

    assert ids() == [3, 4, 5, 6, 7, 8, 9] and ids(months=None) == list(range(1, 10))
    assert ids(start="2024-01-01", end="2024-02-28") == [1, 2]
    assert ids(banks=["a"], min_rating=5) == [5, 7, 9] and ids(topics=["t"]) == [3, 4, 5, 6, 7]
    assert ids(excluded_topics=["t"]) == [8, 9]


def test_kpis_of_an_empty_and_a_single_day_table(spark):
    columns = "bank_name string, branch_name string, city string, star_rating int, ensemble_score double, data_quality_score double, sentiment_label string, review_date date"
    empty = spark.createDataFrame([], columns)
    (row,) = kpis.summary_metrics(empty).collect()
    assert (row.total_reviews, row.date_range_days, row.reviews_per_month, row.positive_percentage) == (0, 0, 0.0, None)
    rows = [("b", "x", 50.0, 10), ("a", "y", 50.0, 10), ("c", "z", 40.0, 10)]
    df = spark.createDataFrame(rows, "bank_name string, other string, positive_percentage double, total_reviews long")
    assert tuple(kpis.top_banks(df).head()) == ("a", "a")


def test_branches_are_made_once_for_their_ranks(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def rating(x):
        made.add(1)
        return x

    rows = [("a", "x", 50.0, 4.0), ("a", "y", 50.0, 3.0), ("a", "z", 60.0, None), ("a", "w", 50.0, 4.0), ("b", "x", 10.0, 1.0), (None, "x", 10.0, 2.0)]
    given = spark.createDataFrame(rows, "bank_name string, branch_name string, positive_percentage double, r double")
    branches = given.select("bank_name", "branch_name", F.lit("c").alias("city"), "positive_percentage", rating("r").alias("avg_rating"))
    found = {(r.bank_name, r.branch_name): r.branch_rank for r in kpis.branch_ranking(branches).collect()}
    assert found == {("a", "z"): 1, ("a", "x"): 2, ("a", "w"): 2, ("a", "y"): 4, ("b", "x"): 1, (None, "x"): 1}
    assert made.value == len(rows)


def test_customers_are_joined_to_orders_before_the_lines(spark, folder):
    from opinara.sources.tables import review_star

    plan = review_star(spark, folder)["fact_reviews"]._jdf.queryExecution().optimizedPlan().toString()
    of_lines, of_orders = re.search(r"l_orderkey\S+ = o_orderkey", plan), re.search(r"o_custkey\S+ = c_custkey", plan)
    assert of_lines.start() < of_orders.start()  # the plan is listed from the top
