"""Whole runs from CSV to reports, on a fixture of French reviews."""

from pyspark.sql import functions as F

from opinara.operators.small import small_table
from opinara.plans import publishing, sentiment
from opinara.plans.warehouse import audit_keys
from opinara.sources import files, schemas
from opinara.sources.seeds import themes

TEXTS = [
    "Accueil excellent, personnel aimable et conseiller rapide",
    "Attente trop longue, guichet lent et personnel impoli",
    "Frais abusifs, commission et tarif inacceptable",
    "Application mobile pratique, distributeur en panne souvent",
]


def test_text_stages_and_star(spark, tmp_path):
    rows = [
        (f"bank {n % 3}", f"branch {n % 5}", "Avenue 1, Rabat", f"{TEXTS[n % 4]} numero{'x' * (n % 9)} {n}", float(n % 6), f"2024-0{1 + n % 9}-11")
        for n in range(60)
    ]
    files.write_csv(small_table(spark, rows, schemas.REVIEWS_RAW), str(tmp_path / "raw"))
    raw = files.read_csv(spark, str(tmp_path / "raw"), schemas.REVIEWS_RAW)
    raw = raw.withColumn("review_seq", F.regexp_extract("review_text", r"(\d+)$", 1).cast("long"))
    out = publishing.run_text_stages(raw, themes(spark), str(tmp_path / "out"), "20250612_001641", n_topics=4)
    assert out.count() == 60 and out.filter("topic_probability is null").count() == 0
    assert (tmp_path / "out" / "sentiment" / "run_ts=20250612_001641" / "_SUCCESS").exists()
    report = spark.read.text(str(tmp_path / "out" / "topic_report" / "run_ts=20250612_001641"))
    assert report.filter("value like 'Nombre de topics: 4'").count() == 1
    by_start = out.groupBy(F.substring("review_text", 1, 7).alias("s")).agg(F.avg("custom_sentiment_score").alias("c"))
    means = {r.s: r.c for r in by_start.collect()}
    assert means["Accueil"] > 0.5 and means["Attente"] < 0
    assert sentiment.label_distribution(out).agg(F.sum("n")).head()[0] == 60

    star = publishing.build_star(out, str(tmp_path / "star"))
    assert star["fact_reviews"].count() == 60 and star["dim_bank"].count() == 3
    audit = audit_keys(star["fact_reviews"], {"bank_id": (star["dim_bank"], "bank_id"), "date_id": (star["dim_date"], "date_id")})
    assert {(r.n_rows, r.n_unresolved) for r in audit.collect()} == {(60, 0)}


def test_published_reports(spark, folder, tmp_path):
    from opinara.sources.tables import review_star

    listed = {r.dataset: r for r in publishing.publish_reports(review_star(spark, folder), str(tmp_path / "r")).collect()}
    assert all(r.written for r in listed.values()) and len(listed) == 9  # grouped text and term counts are apart now
    texts = spark.read.options(**files.CSV_OPTIONS).csv(listed["wordcloud_data"].path)
    assert {"piece", "combined_text"} <= set(texts.columns)
    months = spark.read.options(**files.CSV_OPTIONS).csv(listed["temporal_trends"].path).collect()
    in_order = sorted(months, key=lambda r: int(r.place))
    assert [int(r.place) for r in in_order] == list(range(1, len(months) + 1))
    assert in_order == sorted(months, key=lambda r: (int(r.year or 0), int(r.month or 0)))
    back = spark.read.options(**files.CSV_OPTIONS).csv(listed["main_dataset"].path)
    assert back.count() == listed["main_dataset"].n_rows and "quality_level" in back.columns


def test_reports_of_one_pass(spark, folder):
    """The same rows as each report by itself, from one scan of the fact and one aggregate."""
    from opinara.plans import reports
    from opinara.sources.tables import review_star

    star = review_star(spark, folder)
    seen = []
    fact = star["fact_reviews"].filter(F.assert_true(F.lit(True)).isNull())
    found = reports.all_reports(star | {"fact_reviews": fact})
    for name, report in found.items():
        alone = getattr(reports, name)(star)
        key = lambda r: str([v if not isinstance(v, float) else round(v, 6) for v in r])
        assert sorted(map(key, report.select(alone.columns).collect())) == sorted(map(key, alone.collect())), name
        seen.append(report._jdf.queryExecution().optimizedPlan().toString().count("assert_true"))
    assert seen == [0] * 5  # the groups are written: no report reads the fact again


def test_newest_reviews_come_first(spark, folder):
    from opinara.registry import PLAIN

    rows = [(r.review_date is None, r.review_date) for r in PLAIN["newest_reviews"](spark, folder).collect()]
    days = [d for missing, d in rows if not missing]
    assert days == sorted(days, reverse=True) and rows[len(days) :] == [(True, None)] * (len(rows) - len(days))
