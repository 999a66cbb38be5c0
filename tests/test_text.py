import pytest
from pyspark.sql import functions as F

from opinara.functions import casting, text as tx
from opinara.functions.stemming import stem, stem_tokens
from opinara.plans import cleaning, vocabulary


def test_clean_basic(value):
    given = [
        "Voir https://Exemple.ma/a?b=1 ICI", "ecrire a moi@site.ma vite", "tel +212612345678 ou 0612345678.", "<b>Bien</b> fait",
        "super 😀🚀 top", "a中b", "Été à Fès", "mot colle fin", "", None, "*** ### !!", "l'agence: \"ok\" - oui; non?",
        "a　b", "a@b@c @x y@", "0412345678 061234567", "x < y > z", "tab\t\tand\n\nline",
    ]
    expected = [
        "voir ici", "ecrire a vite", "tel ou .", "bien fait", "super top", "ab", "été à fès", "mot colle fin", "", "", "!!",
        "l'agence: \"ok\" - oui; non?", "ab", "x y", "0412345678 061234567", "x z", "tab and line",
    ]
    assert value(given, "string", tx.clean_basic) == expected


def test_tokens(value):
    given = ["l'agence est fermée, rendez-vous à 10h. fin", "", "a--b c.d e. f"]
    assert value(given, "string", tx.tokenize) == [
        ["l'agence", "est", "fermée", ",", "rendez-vous", "à", "10h", ".", "fin"], [], ["a", "-", "-", "b", "c.d", "e", ".", "f"],
    ]
    assert value([given[0]], "string", tx.cleaned_words) == [["l'agence", "est", "fermée", "rendez-vous", "à", "10h", "fin"]]
    words = ["très", "bon", "ok", "a", "x1", "merci", "accueil"]
    assert value([words], "array<string>", tx.keep_plain_words) == [["bon", "ok", "merci", "accueil"]]
    assert value([words], "array<string>", tx.plain_words) == [["ok", "accueil"]]
    assert value([["bon", "bon", "le"]], "array<string>", lambda c: tx.remove_stop_words(c, ["le"])) == [["bon", "bon"]]


def test_cleaned_words_are_the_words_among_the_tokens(spark, folder):
    from opinara.sources.tables import load

    cleaned = load(spark, folder, "documents").select(tx.clean_basic(F.col("text")).alias("c"))
    both = cleaned.select(tx.remove_punctuation(tx.tokenize(F.col("c"))).alias("a"), tx.cleaned_words(F.col("c")).alias("b"))
    assert both.filter("a <> b").count() == 0


def test_flags_and_counts(value):
    words = ["ABC", "A1B", "123", "ok", "C'EST", None, "AB", "dit NON"]
    assert value(words, "string", tx.has_shouting) == [True, True, False, False, True, False, False, True]
    marks = ["oui!", "non", None]
    assert value(marks, "string", lambda c: tx.contains_mark(c, "!")) == [True, False, False]
    assert value(["Un. Deux! Trois? quatre", "", None, "3.5 fois", "..."], "string", tx.sentence_count) == [4, 0, 0, 1, 0]
    assert value([" a  b c ", "", None], "string", tx.word_count) == [3, 0, 0]


def test_accents(value):
    assert value(["déjà çà où"], "string", tx.fold_accents) == ["deja ca ou"]


def test_dates_are_whole_texts(value):
    texts = ["2024-01-01garbage", "2024-01-012", "2024-01-01T10:11:12.5", "31/12/2023 08:00", "2024/02/03", "2024-01-01 25:00:00", " 2024-01-02 "]
    days = value(texts, "string", casting.to_date)
    assert [d and str(d) for d in days] == [None, None, "2024-01-01", "2023-12-31", "2024-02-03", None, "2024-01-02"]


def test_casts(value):
    assert value(["4.7", "x", None, "NaN", "3"], "string", casting.to_whole) == [4, None, None, None, 3]
    assert value(["4.7", "x", None, "NaN"], "string", lambda c: casting.to_number(c, 3)) == [4.7, 3.0, 3.0, 3.0]
    days = value(["2024-02-29", "2024-02-30", "il y a 2 mois", "31/12/2023", "2024-01-05 10:00:00", None], "string", casting.to_date)
    assert [str(d) for d in days] == ["2024-02-29", "None", "None", "2023-12-31", "2024-01-05", "None"]
    labels = ["4 étoiles", "4.5 stars", "aucune", None, ""]
    assert value(labels, "string", casting.rating_from_label) == [4.0, 4.5, 0.0, 0.0, 0.0]


def test_published_stems():
    given = """toujours cette recommande panne compte tous service conseil grande chaque catastrophique autre heure bancaire
        change ouvrir impossible joindre jamais carte personne manque professionnalisme sans attendre caisse horaire longue
        propre vraiment temps continuellement majestueusement rapidement nationaux eaux""".split()
    expected = """toujour cet recommand pann compt tous servic conseil grand chaqu catastroph autr heur bancair chang ouvr
        impossibl joindr jam cart person manqu professionnal san attendr caiss horair longu propr vrai temp continuel majestu
        rapid national eau""".split()
    assert [stem(w) for w in given] == expected


def _reviews(spark, rows):
    return spark.createDataFrame(rows, "review_seq long, bank_name string, review_text string")


def test_duplicates_keep_the_first(spark):
    rows = [
        (1, "a", "un texte assez long"), (2, "a", "un texte assez long"), (3, "b", "un texte assez long"),
        (4, None, "un texte sans banque"), (5, None, "un texte sans banque"), (6, "a", "court"), (7, "a", None),
        (8, "a", "1234567890"), (9, "a", "123456789"),
    ]
    for n in (1, 8):
        kept = cleaning.remove_duplicates(_reviews(spark, rows).repartition(n))
        assert sorted(r.review_seq for r in kept.collect()) == [1, 3, 4, 8]


def test_cleaning_stage(spark):
    rows = [
        (1, "a", "Les employés: accueil excellent, conseiller rapide et compétent!"),
        (2, "a", "très très bien merci"),
        (3, "b", "attente longue guichets fermes"),
    ]
    out = {r.review_seq: r for r in cleaning.clean_reviews(_reviews(spark, rows)).collect()}
    assert sorted(out) == [1, 3]
    assert out[1].tokens == ["accueil", "excellent", "conseil", "rapid"]
    assert out[3].processed_text == "attent longu guichet ferm" and out[3].word_count == 4 and out[3].char_count == 25
    lemmas = spark.createDataFrame([("fermes", "fermer"), ("guichets", "guichet")], "term string, lemma string")
    for inline in (5_000, 0):
        plain = cleaning.plain_tokens(_reviews(spark, rows))
        found = {r.review_seq: r.tokens for r in cleaning.lemmatize(plain, lemmas, inline_terms=inline).collect()}
        assert found[3] == ["attente", "longue", "guichet", "fermer"] and found[2] == []


def test_odd_spaces_part_words(value):
    given = ["a b c　d\u0085e\x1cf g", "moi@site.ma ici　lui@site.ma", "UN DEUX"]
    assert value(given, "string", tx.words) == [list("abcdefg"), ["moi@site.ma", "ici", "lui@site.ma"], ["UN", "DEUX"]]
    assert value(given, "string", tx.clean_basic) == ["a b cd e f g", "ici", "un deux"]
    assert value(given, "string", tx.has_shouting) == [False, False, True]


@pytest.mark.parametrize("most_shared", [0, 1000])
def test_word_table(spark, most_shared):
    rows = [(1, ["banques", "agence", "banques"]), (2, []), (3, None), (4, ["agences", None, "zzz"])]
    df = spark.createDataFrame(rows, "review_seq long, tokens array<string>").repartition(3)
    first = vocabulary.extend_word_table(None, vocabulary.distinct_words(df.filter("review_seq = 1")))
    table = {r.word: r.normal for r in first.collect()}
    assert table == {"banques": "banqu", "agence": "agenc"}
    # a stored form stands, also where the rules would give another; only the missing words are worked out
    stored = spark.createDataFrame([("banques", "BANK"), ("agence", "agenc")], "word string, normal string")
    second = vocabulary.extend_word_table(stored, vocabulary.distinct_words(df), lambda w: F.when(w != "zzz", F.upper(w)))
    table = {r.word: r.normal for r in second.collect()}
    assert table == {"banques": "BANK", "agence": "agenc", "agences": "AGENCES", "zzz": "zzz"}
    without = second.filter("word <> 'zzz'")
    found = {r.review_seq: r.tokens for r in vocabulary.normalise_words(df, without, most_shared=most_shared).collect()}
    assert found == {1: ["BANK", "agenc", "BANK"], 2: [], 3: None, 4: ["AGENCES", None, "zzz"]}
    none = vocabulary.normalise_words(df, without.limit(0), most_shared=most_shared)
    assert {r.review_seq: r.tokens for r in none.collect()} == dict(rows)


def test_stems_of_lists(spark):
    rows = [(1, ["banques", "rapides"]), (2, []), (3, None), (4, [None, "agences"])]
    df = spark.createDataFrame(rows, "n int, t array<string>").repartition(2)
    assert {r.n: r.s for r in df.select("n", stem_tokens("t").alias("s")).collect()} == {1: ["banqu", "rapid"], 2: [], 3: None, 4: [None, "agenc"]}


def test_cleaning_with_a_word_table(spark):
    table = spark.createDataFrame([("attente", "ATT")], "word string, normal string")
    out = cleaning.clean_reviews(_reviews(spark, [(1, "a", "attente longue guichets fermes")]), word_table=table).head()
    assert out.processed_text == "ATT longue guichets fermes"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_long_lemma_table_is_looked_up_in_the_rows(spark):
    lemmas = spark.createDataFrame([("aa", "x"), ("bb", "y")], "term string, lemma string")
    df = spark.createDataFrame([(1, ["bb", "cc", "aa"]), (2, []), (3, None)], "review_seq long, tokens array<string>")
    out = cleaning.lemmatize(df, lemmas, inline_terms=0)
    assert [r.tokens for r in out.orderBy("review_seq").collect()] == [["y", "cc", "x"], [], []]
    assert "posexplode" not in _plan(out) and "posexplode" in _plan(cleaning.lemmatize(df, lemmas, inline_terms=0, most_shared=0))


def test_a_text_is_cleaned_once(spark):
    from opinara.plans import topics

    df = spark.createDataFrame([(1, "Voir HTTPS://a.b @ 0612345678 <b>ici</b> un deux")], "review_seq long, review_text string")
    out = topics.prepare_documents(cleaning.process_reviews(df, stem=False).select("review_seq", "processed_text"))
    assert _plan(out).count("https?") == 1
    assert [r.document for r in out.collect()] == ["voir ici deux"]


def test_words_of_a_long_table_are_looked_up_by_block(spark):
    given = [(1, ["a", "b", None, "a"], "x"), (2, [], "y"), (3, None, "z"), (4, ["c", "zz"], None)]
    rows = spark.createDataFrame(given + [(n, ["a", f"w{n}"], "q") for n in range(5, 60)], "review_seq long, tokens array<string>, other string")
    pairs = [("a", "A"), ("c", "c"), ("b", "BB")] + [(f"w{n}", f"n{n}") for n in range(5, 50)]
    table = spark.createDataFrame(pairs, "word string, normal string")
    normal = dict(pairs)
    wanted = {r.review_seq: r.tokens and [normal.get(w, w) for w in r.tokens] for r in rows.collect()}
    for at_once in (3, vocabulary.WORDS_AT_ONCE):
        found = vocabulary._by_block(rows, table, "tokens", "review_seq", at_once)
        assert found.columns == rows.columns and {r.review_seq: r.tokens for r in found.collect()} == wanted
    by_block = vocabulary.normalise_words(rows, table, most_shared=0)
    assert "CoGroup" in by_block._jdf.queryExecution().executedPlan().toString()
    assert {r.review_seq: (r.tokens, r.other) for r in by_block.collect()} == {r.review_seq: (wanted[r.review_seq], r.other) for r in rows.collect()}
    twice = vocabulary.normalise_words(rows.union(rows.limit(1)), table, most_shared=0)
    assert "CoGroup" not in twice._jdf.queryExecution().executedPlan().toString() and twice.count() == 60
