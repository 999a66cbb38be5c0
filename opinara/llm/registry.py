"""The registered queries of the operators, with DuckDB SQL where it can express them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import alignment, bbit_minhash, decontaminate, jaccard_join, language_id, line_dedup, mixing, prefix_trie, quality_rules, substring_dedup, token_counts, token_file, toxicity
from opinara.llm.common import documents, scratch_path

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op1_substring_dedup",
    f"""
    WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
    places AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50),
    windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM places),
    firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
    gone AS (
        SELECT DISTINCT doc_id, i + j AS pos
        FROM windows JOIN firsts USING (h), range(50) AS r(j) WHERE doc_id > first
    ),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM docs),
    kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t
        FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
    )
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
        sha256(coalesce(k.t, '')) AS kept_sha256
    FROM docs d LEFT JOIN kept k USING (doc_id)
    """,
)
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(documents(spark, folder))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op7_token_file")
def op7_token_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_file.write_tokens(documents(spark, folder), path, public_tokenizers.path(TOKENIZER), end_id=0)
    return token_file.read_documents(spark, path)


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, folder), public_tokenizers.path(TOKENIZER))


def fold(divisor: int) -> Column:
    """Remainder of crc32 of doc_id as text; rows without a doc_id are in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor, F.lit(0))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(fold(4) != 2))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "language.lang_pred", "language.score")


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = documents(spark, folder).select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(docs, labels.filter(fold(3) != 1))
    return toxicity.score_texts(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept")


@query("op5_mixing")
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@query(
    "op10_decontamination",
    r"""
    WITH shingles AS (
        SELECT kind, id, unnest(list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])) AS s
        FROM (
            SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)
        ) WHERE len(w) >= 5
    ),
    sizes AS (SELECT id AS item_id, count(*) AS n_shingles FROM shingles WHERE kind = 'b' GROUP BY id),
    found AS (
        SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_found
        FROM shingles d JOIN shingles b ON d.s = b.s AND d.kind = 'd' AND b.kind = 'b' GROUP BY ALL
    )
    SELECT doc_id, item_id, n_shingles::BIGINT AS n_shingles, n_found::BIGINT AS n_found, n_found / n_shingles AS containment
    FROM found JOIN sizes USING (item_id) WHERE 100 * n_found >= 80 * n_shingles
    """,
)
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query(
    "op6_jaccard_join",
    r"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    sets AS (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [md5(array_to_string(w, ' '))]
            ELSE list_distinct([md5(array_to_string(w[i:i + 3], ' ')) FOR i IN range(1, len(w) - 2)]) END) AS s
        FROM docs
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
    ),
    reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
    )
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(other) FROM reached r WHERE r.doc_id = d.doc_id) AS component_id
    FROM docs d LEFT JOIN sizes USING (doc_id)
    """,
)
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.document_components(documents(spark, folder))


@query(
    "op2_line_dedup",
    r"""
    WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL),
    lines AS (
        SELECT doc_id, no, trim(s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
        FROM (SELECT doc_id, unnest(range(1, len(p) + 1)) AS no, unnest(p) AS s FROM parts)
    ),
    worded AS (SELECT doc_id, no, line FROM lines WHERE line <> ''),
    firsts AS (SELECT line, min((doc_id, no)) AS first, length(line) AS n FROM worded GROUP BY line),
    keys AS (
        SELECT line, first, n, m, substr(line, 1, m // 2) AS lead, substr(line, n - (m - m // 2) + 1) AS tail
        FROM firsts, (VALUES (0), (1)) AS c(shorter), LATERAL (SELECT n - shorter AS m) WHERE n >= 20
    ),
    pairs AS (
        SELECT DISTINCT a.line AS a, b.line AS b FROM keys a JOIN keys b ON a.m = b.m AND a.lead = b.lead AND a.first > b.first
        UNION SELECT DISTINCT a.line, b.line FROM keys a JOIN keys b ON a.m = b.m AND a.tail = b.tail AND a.first > b.first
    ),
    cut AS (
        SELECT a, b, CASE WHEN length(a) >= length(b) THEN a ELSE b END AS x, CASE WHEN length(a) >= length(b) THEN b ELSE a END AS y
        FROM pairs
    ),
    near AS (
        SELECT DISTINCT a AS line FROM (SELECT a, x, y, unnest(range(1, length(x) + 1)) AS i FROM cut)
        WHERE substr(x, 1, i - 1) || substr(x, i + 1) = CASE WHEN length(x) = length(y) THEN substr(y, 1, i - 1) || substr(y, i + 1) ELSE y END
    ),
    judged AS (
        SELECT doc_id, no, first < (doc_id, no) OR line IN (SELECT line FROM near) AS gone FROM worded JOIN firsts USING (line)
    )
    SELECT d.doc_id, count(no)::BIGINT AS n_lines, coalesce(sum(gone::INT), 0)::BIGINT AS n_removed,
        coalesce(string_agg(CASE WHEN gone THEN no END::VARCHAR, ',' ORDER BY no), '') AS removed
    FROM documents d LEFT JOIN judged j USING (doc_id) GROUP BY d.doc_id
    """,
)
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    report = line_dedup.line_report(documents(spark, folder))
    return report.withColumn("removed", F.array_join("removed", ","))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(documents(spark, folder), public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


# crc32 of a decimal number, bit by bit
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, [ascii(ch)::BIGINT FOR ch IN string_split(c::VARCHAR, '')]),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)))"""


@query(
    "op13_prefix_trie",
    rf"""
    WITH own AS (
        SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS j
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    convs AS (SELECT c, {_CRC32} % 4 AS h FROM (SELECT DISTINCT c FROM own)),
    shared AS (SELECT v.c, v.h, count(o.j) AS k FROM convs v LEFT JOIN own o ON o.c = v.c - v.c % 20 AND o.j <= v.h GROUP BY v.c, v.h),
    turns AS (
        SELECT v.c, o.j AS pos, o.r, o.x FROM shared v JOIN own o ON o.c = v.c - v.c % 20 AND o.j <= v.h
        UNION ALL SELECT v.c, o.j - v.h + v.k, o.r, o.x FROM shared v JOIN own o ON o.c = v.c AND o.j > v.h
    ),
    marked AS (
        SELECT c, pos, md5(concat(length(r), ':', r, x)) AS t, len(regexp_extract_all(x, '[^ 	-]+')) AS words FROM turns
    ),
    members AS (
        SELECT c, 0 AS d, '' AS p, 0 AS words FROM convs
        UNION ALL SELECT c, pos, string_agg(t, '') OVER (PARTITION BY c ORDER BY pos ROWS UNBOUNDED PRECEDING), words FROM marked
    ),
    steps AS (
        SELECT *, lag(p) OVER (PARTITION BY c ORDER BY d) AS q, d = max(d) OVER (PARTITION BY c) AS is_end FROM members
    ),
    nodes AS (
        SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, min(words) AS words, min(q) AS q,
            sha256(coalesce(string_agg(CASE WHEN is_end THEN c END::VARCHAR, ',' ORDER BY c), '')) AS ends_sha256
        FROM steps GROUP BY d, p
    ),
    children AS (SELECT d - 1 AS d, q AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY d, q),
    whole AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k USING (d, p)),
    sums AS (
        SELECT m.d, m.p, sum((n.n_children = 0)::BIGINT) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
        FROM whole n JOIN members m ON m.c = n.conv_id AND m.d <= n.d GROUP BY m.d, m.p
    )
    SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves,
        s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
    FROM whole n JOIN sums s USING (d, p) LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.q
    """,
)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.with_end_digests(*prefix_trie.build(spark.read.parquet(f"{folder}/conversations.parquet")))


@query(
    "op12_bbit_minhash",
    r"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    sets AS (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [md5(array_to_string(w, ' '))]
            ELSE list_distinct([md5(array_to_string(w[i:i + 2], ' ')) FOR i IN range(1, len(w) - 1)]) END) AS s
        FROM docs
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
    ),
    reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
    )
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least AS component_id, d.doc_id = least AS kept
    FROM docs d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id) USING (doc_id)
    """,
)
def op12_bbit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return bbit_minhash.near_duplicates(documents(spark, folder))
