"""The operators as queries over the given tables, and the SQL that must agree with them.

No SQL: op2 (trained character models), op4 (differencing), op7 and op9 (trained classifiers),
op8 (dynamic programming). The tests hold these against brute force or held-out labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import embeddings, licences, mixing, neardup, packing, quality, repeats, runs, search, secrets, sharding, signatures, toxicity
from tidemark.llm.terms import TERM


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_epsilon_grid_join(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.link(_table(spark, folder, "embeddings"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(_table(spark, folder, "documents"))


def op3_branch_and_bound_topk(spark: SparkSession, folder: str) -> DataFrame:
    return search.nearest(_table(spark, folder, "embeddings"))


def op4_differencing_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, folder, "documents"))


def op5_systematic_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op6_bagminhash_classes(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.classes(_table(spark, folder, "documents"))


def op7_toxicity_pu(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op9_subword_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_block_anchor_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, folder, "documents")).drop("kept")


def op11_bit_sliced_search(spark: SparkSession, folder: str) -> DataFrame:
    return signatures.rank(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.collapse(_table(spark, folder, "documents"), plant=True).drop("runs", "collapsed")


def op13_license_templates(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    run.__name__: run
    for run in (
        op1_epsilon_grid_join,
        op2_secret_scan,
        op3_branch_and_bound_topk,
        op4_differencing_shards,
        op5_systematic_mix,
        op6_bagminhash_classes,
        op7_toxicity_pu,
        op8_length_buckets,
        op9_subword_quality,
        op10_block_anchor_repeats,
        op11_bit_sliced_search,
        op12_periodic_runs,
        op13_license_templates,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')"


def _pattern(template: str) -> str:
    """A template as a regular expression over words that each follow a space."""
    parts = []
    for mark in template.lower().replace("[[", " [[ ").replace("]]", " ]] ").split():
        low, _, high = mark.strip("{}").partition(",")
        parts.append({"[[": "(?:", "]]": ")?"}.get(mark, f"(?: [^ ]+){{{low},{high}}}" if high else f" {mark}"))
    return "".join(parts) + " "


_LABELLED = ", ".join(f"('{name}', {auto.mandatory}, '{_pattern(text)}')" for (name, text), auto in zip(licences.TEMPLATES, licences.Scanner().automata, strict=True))
_PHRASED = ", ".join(f"('{name}', {len(phrase.split())}, {phrase.split()})" for phrase, name in licences.PHRASES)

_REACHED = """
reach(a, b) AS (
    SELECT a, b FROM links
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)"""

SQL: dict[str, str] = {
    "op1_epsilon_grid_join": f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q
      ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
    WHERE list_inner_product(p.v, q.v) / sqrt(list_inner_product(p.v, p.v)) / sqrt(list_inner_product(q.v, q.v)) >= 0.93
),{_REACHED},
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(b, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(b, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c ON c.a = e.vec_id LEFT JOIN least_of l ON l.a = e.vec_id
""",
    "op3_branch_and_bound_topk": """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
""",
    "op5_systematic_mix": f"""
WITH sized AS (SELECT doc_id, source, len({_WORDS}) AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
    SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 3 * source_size AS cap FROM sources
),
ordered AS (
    SELECT *,
        (sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER earlier, 0)::BIGINT AS left_over,
        (sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER earlier, 0)::BIGINT AS heavy
    FROM weighted
    WINDOW earlier AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
capped AS (SELECT *, cap * heavy < left_over * weight AS is_capped FROM ordered),
levels AS (SELECT arg_max(left_over / heavy, heavy) AS level FROM capped WHERE NOT is_capped),
targets AS (
    SELECT source, source_size, CASE WHEN is_capped THEN cap::DOUBLE ELSE coalesce(level * weight, 0) END AS target
    FROM capped LEFT JOIN levels ON true
),
planned AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size * 1048576 + 0.5)::BIGINT, 3 * 1048576) ELSE 0 END AS units,
        list_sum(list_transform(range(1, 6), lambda i:
            (instr('0123456789abcdef', substr(md5(coalesce(source, '')), i, 1)) - 1) * (16 ** (5 - i))::BIGINT))::BIGINT AS first_offset
    FROM targets
),
placed AS (
    SELECT s.doc_id, s.size, p.*, row_number() OVER (PARTITION BY s.source ORDER BY half, CASE WHEN half THEN -size ELSE size END, doc_id) - 1 AS k
    FROM (SELECT *, substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 1) >= '8' AS half FROM sized) s
    JOIN planned p ON p.source IS NOT DISTINCT FROM s.source
),
drawn AS (
    SELECT placed.*, n, (first_offset + n * 65536) % 1048576 AS shift FROM placed, range(16) r(n)
),
crossed AS (
    SELECT doc_id, size, source, source_size, target, n, k, ((k + 1) * units + shift) // 1048576 - (k * units + shift) // 1048576 AS copies FROM drawn
),
best AS (
    SELECT source, arg_min(n, (far, n)) AS n FROM (
        SELECT source, n, abs(sum(copies * size)::BIGINT - any_value(target)) AS far FROM crossed GROUP BY source, n
    ) GROUP BY source
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies
FROM crossed JOIN best ON best.source IS NOT DISTINCT FROM crossed.source AND best.n = crossed.n
""",
    "op6_bagminhash_classes": f"""
WITH RECURSIVE bodies AS (SELECT text, min(doc_id) AS doc_id FROM documents WHERE len({_WORDS}) > 0 GROUP BY text),
words AS (SELECT doc_id, {_WORDS} AS w FROM bodies),
runs AS (
    SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS run FROM words
),
bags AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
sizes AS (SELECT doc_id, sum(n) AS n FROM bags GROUP BY doc_id),
shared AS (
    SELECT p.doc_id AS a, q.doc_id AS b, sum(least(p.n, q.n)) AS n
    FROM bags p JOIN bags q ON p.run = q.run AND p.doc_id <> q.doc_id GROUP BY p.doc_id, q.doc_id
),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 10 * shared.n >= 8 * (x.n + y.n - shared.n)
),{_REACHED},
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
classes AS (SELECT text, least(doc_id, coalesce(b, doc_id)) AS class_id FROM bodies LEFT JOIN least_of ON a = doc_id)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(class_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN classes ON classes.text = documents.text
""",
    "op10_block_anchor_repeats": f"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS run FROM starts),
repeated AS (SELECT doc_id, i FROM windows WHERE run IN (SELECT run FROM windows GROUP BY run HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM repeated),
lost AS (SELECT doc_id, list(i) AS places FROM gone GROUP BY doc_id)
SELECT words.doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(CASE WHEN places IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
           list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(places, i)), lambda i: w[i]), ' ') END) AS kept_sha256
FROM words LEFT JOIN lost ON lost.doc_id = words.doc_id
""",
    "op11_bit_sliced_search": f"""
WITH terms AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS t FROM documents),
sizes AS (SELECT d, doc_id, len(t) AS n FROM terms WHERE len(t) > 0),
corpus AS (SELECT count(*) AS docs, sum(n)::HUGEINT AS words FROM sizes),
norms AS (SELECT d, doc_id, (100 - 90 + (90 * n::HUGEINT * docs) // words)::BIGINT AS m FROM sizes, corpus),
held AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM terms) GROUP BY d, term),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
spread AS (SELECT term, count(*) AS df FROM held GROUP BY term),
weighed AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM spread, corpus),
scored AS (
    SELECT item_id, doc_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN norms USING (d) GROUP BY item_id, doc_id, d
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
""",
    "op12_periodic_runs": f"""
WITH spoken AS (SELECT doc_id, {_WORDS} AS w FROM documents),
keyed AS (
    SELECT *, len(w) AS n, xor(4294967295, list_reduce(
        flatten([[4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))]),
        lambda h, x: CASE WHEN x >= 0 THEN xor(h, x) WHEN h % 2 = 1 THEN xor(h // 2, 3988292384::BIGINT) ELSE h // 2 END)) AS h
    FROM spoken
),
shaped AS (SELECT *, h % 10 = 0 AND n > 0 AS planted, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a FROM keyed),
stepped AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM shaped),
texts AS (
    SELECT doc_id, n, CASE WHEN planted
        THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w END AS w
    FROM stepped
),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM texts),
lagged AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM lagged),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS length FROM islands GROUP BY doc_id, q, island),
found AS (SELECT doc_id, s, length, min(q) AS q FROM stretches WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, s, length),
listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS listing,
        first(s ORDER BY length DESC, s, q) AS s, first(length ORDER BY length DESC, s, q) AS length, first(q ORDER BY length DESC, s, q) AS q
    FROM found GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM found),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, length, q AS period, 1000 * length // q AS exponent_milli,
       sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed l ON l.doc_id = t.doc_id LEFT JOIN kept k ON k.doc_id = t.doc_id
""",
    "op13_license_templates": f"""
WITH spoken AS (SELECT doc_id, {_TERMS} AS w FROM documents),
joined AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS body FROM spoken),
phrases(label, size, words) AS (VALUES {_PHRASED}),
templates(label, size, pattern) AS (VALUES {_LABELLED}),
places AS (
    SELECT doc_id, label, size, unnest(list_filter(range(0, len(w) - size + 1), lambda i: w[i + 1:i + size] = words)) AS i
    FROM joined, phrases WHERE contains(body, ' ' || array_to_string(words, ' ') || ' ')
),
counted AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM places GROUP BY doc_id),
matched AS (
    SELECT doc_id, label, size, true AS base FROM places
    UNION ALL SELECT doc_id, label, size, false FROM joined, templates WHERE regexp_matches(body, pattern)
),
named AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
        max(size) AS size FROM matched GROUP BY doc_id
)
SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(size / (size + {licences.DOUBT}), 0)::DOUBLE AS score
FROM spoken s LEFT JOIN counted c ON c.doc_id = s.doc_id LEFT JOIN named m ON m.doc_id = s.doc_id
""",
}
