import pytest
from pyspark.sql import functions as F

from opinara import fixed_values as fixed
from opinara.plans import warehouse
from opinara.sources import schemas, versions


def _loaded(spark):
    rows = [
        (1, "a", "n1", "Avenue, Fès", "2024-01-02", 0.5), (2, "a", "n1", None, "il y a 2 mois", None),
        (3, "b", None, None, "2024-01-02", 0.5), (4, None, "n1", "Avenue, Fès", None, -0.5),
    ]
    columns = "review_seq long, bank_name string, branch_name string, branch_location string, review_date string, textblob_polarity double"
    extra = {"review_text": F.lit("texte"), "rating": F.lit(4.0), "word_count": F.lit(3), "char_count": F.lit(5)}
    flags = {c: F.lit(True) for c in ("has_exclamation", "has_question", "has_caps")}
    return spark.createDataFrame(rows, columns).withColumns(extra | flags)


def test_narrow_load_keeps_every_row_and_resolves_every_key(spark):
    reviews = _loaded(spark)
    dims = warehouse.star_dimensions(reviews)
    assert {n: d.count() for n, d in dims.items()} == {"dim_bank": 2, "dim_branch": 3, "dim_date": 1, "dim_sentiment": 2}
    fact = warehouse.load_fact(reviews, dims)
    rows = {r.review_id: r for r in fact.collect()}
    assert fact.columns == [f.name for f in schemas.FACT_NARROW] and len(rows) == 4
    assert rows[4].bank_id is None and rows[2].date_id is None and rows[2].sentiment_id is None
    assert all(r.branch_id for r in rows.values()) and rows[1].branch_id == rows[4].branch_id
    audit = warehouse.audit_keys(fact, {"bank_id": (dims["dim_bank"], "bank_id"), "branch_id": (dims["dim_branch"], "branch_id")})
    assert {(r.key_column, r.n_rows, r.n_unresolved) for r in audit.collect()} == {("bank_id", 3, 0), ("branch_id", 4, 0)}


def test_city_of_a_branch(spark):
    assert {r.city for r in warehouse.branch_dimension(_loaded(spark)).collect()} == {"Fès", None}


def test_calendar(spark):
    days = {str(r.full_date): r for r in warehouse.calendar(spark).collect()}
    assert len(days) == 731
    first = days["2023-01-01"]
    assert (first.day_of_week, first.day_name, first.week_of_year, first.is_weekend) == (7, "Dimanche", 52, True)
    leap = days["2024-02-29"]
    assert (leap.date_id, leap.month_name, leap.quarter, leap.day_name) == (20240229, "Février", 1, "Jeudi")


def test_seeds_are_inserted_once(spark):
    empty = spark.createDataFrame([], schemas.DIM_SENTIMENT)
    once = warehouse.seed_if_empty(empty, warehouse.sentiment_dimension(spark), ["sentiment_label"])
    twice = warehouse.seed_if_empty(once, warehouse.sentiment_dimension(spark), ["sentiment_label"])
    assert once.count() == twice.count() == 4
    topics = {r.topic_name: r for r in warehouse.topic_dimension(spark, "2025-06-12 00:00:00").collect()}
    assert len(topics) == 9 and len(topics["frais_tarifs"].topic_keywords) == 16 and topics["autres"].topic_keywords is None


def test_enriched_load(spark):
    rows = [
        (1, "a", "un avis assez long", "4.7", "positive", "frais_tarifs", "2024-02-29", "0.25", "true"),
        (2, "a", "court", None, "mixed", "theme_x y", None, None, None),
        (3, "z", "un avis assez long", "n/a", "neutral", "autres", "2024-02-29", "0.1", "false"),
        (4, "a", None, "0", None, None, "2030-01-01", "nan", "false"),
    ]
    columns = """review_seq long, bank_name string, review_text string, rating string, sentiment_label string,
        topic_label string, review_date string, ensemble_score string, has_caps string"""
    typed = warehouse.typed_fact(spark.createDataFrame(rows, columns))
    assert [(r.review_id, r.bad_columns) for r in warehouse.rejected_rows(typed).collect()] == [(3, ["rating"])]
    dims = {
        "dim_bank": spark.createDataFrame([(7, "a")], "bank_id long, bank_name string"),
        "dim_sentiment": warehouse.sentiment_dimension(spark),
        "dim_topic": warehouse.topic_dimension(spark),
        "dim_date": warehouse.calendar(spark),
    }
    fact = {r.review_id: r for r in warehouse.load_enriched_fact(typed, dims).collect()}
    assert sorted(fact) == [1, 2, 4]
    assert (fact[1].star_rating, fact[1].sentiment_id, fact[1].topic_id, fact[1].date_id) == (4, 1, 3, 20240229)
    assert (fact[1].has_caps, fact[2].has_caps, round(fact[1].data_quality_score, 9)) == (True, False, 1.0)
    assert (fact[2].sentiment_id, fact[2].topic_id, fact[2].date_id, fact[2].star_rating) == (4, 9, None, None)
    assert fact[4].date_id is None and str(fact[4].review_date) == "2030-01-01" and fact[4].ensemble_score is None
    assert (fact[2].data_quality_score, fact[4].data_quality_score) == (0.5, 0.5)


def test_schema_evolution_and_audits(spark, tmp_path):
    narrow = spark.createDataFrame([], schemas.FACT_NARROW)
    rich = warehouse.evolve_fact(narrow)
    assert set(rich.columns) == {f.name for f in schemas.FACT_NARROW} | {f.name for f in schemas.FACT_ADDED}
    assert warehouse.evolve_fact(rich).columns == rich.columns and len(schemas.FACT_ADDED) == 26
    found = {r.column_name: r.present for r in warehouse.audit_columns(narrow).collect()}
    assert found["topic_id"] is False and found["bank_id"] is True and len(found) == 8
    tables = warehouse.empty_star(spark)
    assert sorted(tables) == sorted(schemas.EXPECTED_TABLES)
    tables.pop("dim_reviewer")
    audit = {r.table_name: (r.present, r.n_rows) for r in warehouse.audit_tables(spark, tables).collect()}
    assert audit["dim_reviewer"] == (False, None) and audit["dim_bank"] == (True, 0)
    assert "dim_reviewer" in warehouse.create_missing(spark, tables)


def test_replace_is_explicit(spark, tmp_path):
    fact = spark.createDataFrame([(1, "2024-01-02")], "review_id long, d string").select("review_id", F.to_date("d").alias("review_date"))
    path = str(tmp_path / "fact")
    assert warehouse.replace_fact(fact, path).count() == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        warehouse.replace_fact(fact, path)
    assert warehouse.replace_fact(fact, path, replace=True).count() == 1


def test_readers_see_whole_versions(spark, tmp_path):
    """A reader of the old rows goes on reading them, a write that fails leaves them, and new rows may come from the old ones."""
    path, schema = str(tmp_path / "fact"), "review_id long, n int"
    with pytest.raises(FileNotFoundError):
        versions.current_table(spark, path, spark.createDataFrame([], schema).schema)
    old = spark.createDataFrame([(1, 10), (2, 20)], schema)
    versions.publish_version(old, path)
    before = versions.current_table(spark, path, old.schema)
    broken = before.withColumn("n", F.when(F.col("review_id") == 1, F.col("n")).otherwise(F.raise_error(F.lit("broken")).cast("int")))
    with pytest.raises(Exception, match="broken"):
        versions.publish_version(broken, path, replace=True)
    assert sorted(versions.current_table(spark, path, old.schema).collect()) == [(1, 10), (2, 20)]
    versions.publish_version(before.withColumn("n", F.col("n") + 1), path, replace=True)
    assert sorted(versions.current_table(spark, path, old.schema).collect()) == [(1, 11), (2, 21)]
    assert sorted(before.collect()) == [(1, 10), (2, 20)] and versions.current_version(spark, path)[0] == 2


def test_dimensions_are_extended(spark):
    reviews = _loaded(spark)
    first = warehouse.star_dimensions(reviews.filter("review_seq > 2"))
    second = warehouse.extend_star(first, reviews)
    for table, (key, natural) in warehouse.STAR_KEYS.items():
        old, new = ({tuple(r[c] for c in natural): r[key] for r in d[table].collect()} for d in (first, second))
        assert {k: new[k] for k in old} == old and sorted(new.values()) == list(range(1, len(new) + 1))
    assert warehouse.load_fact(reviews, second).filter("branch_id is null").count() == 0
    highest = warehouse.star_highest(second)
    later = warehouse.extend_star({n: d.limit(0) for n, d in second.items()}, reviews, highest)
    assert later["dim_branch"].agg(F.min("branch_id")).head()[0] == 4


def test_reviewers(spark):
    rows = [("x", 4.0, "2024-01-02"), ("x", 5.0, "2024-03-02"), ("x", 0.0, None), (None, 1.0, None)]
    found = warehouse.reviewer_dimension(spark.createDataFrame(rows, "reviewer_name string, rating double, review_date string"))
    (row,) = found.collect()
    assert (row.review_count, str(row.avg_rating), str(row.first_review_date)) == (3, "4.50", "2024-01-02")
    assert found.columns == [f.name for f in schemas.DIM_REVIEWER] and len(fixed.SENTIMENT_ROWS) == 4
