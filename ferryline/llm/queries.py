"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm import (
    decontaminate, fingerprints, html_text, lines, lm_score, merkle, mixing, near_dups, phrases,
    secrets, substrings, top_k, toxicity,
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int) -> Column:
    """True for the rows of fold 0: crc32 of the id as text, modulo the folds."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == 0


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it leaks a benchmark item, how many, the best covered one."""
    rows, leaks = decontaminate.find_leaks(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    per_row = leaks.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.max(F.struct("coverage", (-F.col("item_id")).alias("minus"), "consistency")).alias("best"))
    return rows.select("uid", "doc.doc_id").join(per_row, "uid", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        (-F.col("best.minus")).alias("item_id"), F.col("best.coverage").alias("coverage"),
        F.col("best.consistency").alias("consistency"))


def op2_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, of its edit with the next one, and their likeness."""
    return fingerprints.fingerprint_neighbours(read(spark, sf_dir, "documents"))


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, and how many of them look live or copied."""
    found = secrets.scan_secrets(read(spark, sf_dir, "documents"), keep=["doc_id"])
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE))

    def count(test) -> Column:
        return F.size(F.filter(spans, test)).cast("bigint")

    def of_kind(kind: str):
        return lambda s: s["kind"] == kind

    return found.select(
        "doc.doc_id",
        *[count(of_kind(k)).alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(spans).alias("spans"),
        count(lambda s: s["status"] == "live").alias("n_live"),
        count(lambda s: s["status"] == "example").alias("n_example"))


def op4_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot of every document in a mix with square-root weights."""
    return mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source"))


def op5_nb_ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model learnt outside fold 0 of 5."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn=~fold(5))
    return toxicity.score_toxicity(docs.select("doc_id", fold(5).alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "score", "predicted")


def op6_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document among near-duplicates, and whether it stays."""
    _, marks = near_dups.near_duplicates(read(spark, sf_dir, "documents"), keep=[])
    return marks.select(F.col("id").alias("doc_id"), "class_id", "kept")


def op7_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lattice score of every document, learnt outside fold 0 of 10."""
    return lm_score.score_texts(read(spark, sf_dir, "documents"), ~fold(10))


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 35-word sequences that occur elsewhere."""
    return substrings.remove_repeats(read(spark, sf_dir, "documents"))


def op9_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later occurrences of repeated three-line windows."""
    return lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_text(read(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document in a manifest by source; texts of fold 0 of 5 are tampered with."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
                      F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    manifest = merkle.build(
        read(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
        claims={"text": tampered}, keep=["doc_id"])
    return merkle.audit(manifest).select(
        "doc.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest inner products of every hundredth vector with all others."""
    return top_k.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language by their weakest cut."""
    return phrases.mine_phrases(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {q.__name__: q for q in (
    op1_template_decontamination, op2_chunk_fingerprints, op3_secret_ownership, op4_pfair_mixing,
    op5_nb_ngram_toxicity, op6_probminhash, op7_subword_lattice, op8_recompression,
    op9_line_windows, op10_text_density, op11_merkle_manifest,
    op12_ball_tree_top_k, op13_phrase_collocations, pipeline)}

LINES_SQL = """
    WITH parts AS (
        SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
    single AS (
        SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM parts),
    windows AS (
        SELECT doc_id, pos, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
        FROM single WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    later AS (
        SELECT doc_id, pos FROM windows WHERE c IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) > 1),
    covered AS (
        SELECT DISTINCT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) t(k)),
    kept AS (
        SELECT s.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
               coalesce(string_agg(s.line, chr(10) ORDER BY s.pos) FILTER (c.pos IS NULL), '') AS body
        FROM single s LEFT JOIN covered c ON s.doc_id = c.doc_id AND s.pos = c.pos
        GROUP BY s.doc_id)
    SELECT doc_id, n_lines, n_removed, sha256(body) AS kept_sha256 FROM kept"""

#: The schedule slot by slot, for tables whose sources all are scheduled by themselves.
MIX_SQL = f"""
    WITH RECURSIVE counts AS (
        SELECT source AS src, count(*) AS n FROM documents GROUP BY source),
    weighed AS (
        SELECT src, row_number() OVER (ORDER BY coalesce('=' || src, '')) AS rank,
               (n + {mixing.BLOCK_DOCS} - 1) // {mixing.BLOCK_DOCS} AS blocks,
               CAST(floor(sqrt(n) * 1000) AS BIGINT) AS w FROM counts),
    table_of AS (
        SELECT list(blocks ORDER BY rank) AS nb, list(w ORDER BY rank) AS w,
               list(CAST(0 AS BIGINT)) AS zeros, range(1, count(*) + 1) AS ids FROM weighed),
    sched AS (
        SELECT 0 AS phase, 0 AS t, 0 AS slot, zeros AS done, zeros AS d, zeros AS share, CAST(NULL AS BIGINT) AS pick
        FROM table_of
        UNION ALL
        SELECT phase + CAST(fresh AS INTEGER), CASE WHEN fresh THEN 0 ELSE t + 1 END,
               CASE WHEN fresh THEN slot ELSE slot + 1 END,
               CASE WHEN fresh THEN done ELSE list_transform(done, lambda x, i: x + CAST(i = best AS BIGINT)) END,
               CASE WHEN fresh THEN zeros ELSE list_transform(d, lambda x, i: x + CAST(i = best AS BIGINT)) END,
               CASE WHEN NOT fresh THEN share ELSE list_transform(base, lambda x, i: x + CAST(rest[i] >= 0 AND
                   len(list_filter(ids, lambda j: rest[j] > rest[i] OR rest[j] = rest[i] AND j < i))
                   < {mixing.PERIOD} - list_sum(base) AS BIGINT)) END,
               CASE WHEN fresh THEN NULL ELSE best END
        FROM (
            SELECT *, best IS NULL OR done[best] = nb[best] AS fresh,
                   list_transform(ids, lambda i: CASE WHEN done[i] < nb[i] THEN
                       greatest(1, {mixing.PERIOD - 1} * w[i] // w_all) ELSE 0 END) AS base,
                   list_transform(ids, lambda i: CASE WHEN done[i] < nb[i] THEN
                       {mixing.PERIOD - 1} * w[i] % w_all ELSE -1 END) AS rest
            FROM (
                SELECT *, list_min(list_filter(list_transform(ids, lambda i:
                           CASE WHEN d[i] * {mixing.PERIOD} < (t + 1) * share[i]
                           THEN {{'d': ((d[i] + 1) * {mixing.PERIOD} + share[i] - 1) // share[i], 'i': i}} END),
                           lambda x: x IS NOT NULL)).i AS best,
                       CAST(list_sum(list_transform(ids, lambda i:
                           CASE WHEN done[i] < nb[i] THEN w[i] ELSE 0 END)) AS BIGINT) AS w_all
                FROM sched, table_of)
            WHERE w_all > 0)),
    places AS (
        SELECT pick AS rank, done[pick] - 1 AS block, slot - 1 AS slot, slot - t AS start,
               d[pick] - 1 AS b, share[pick] AS share, phase
        FROM sched WHERE pick IS NOT NULL),
    ranked AS (
        SELECT doc_id, source, (row_number() OVER (PARTITION BY source
               ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1) // {mixing.BLOCK_DOCS} AS block FROM documents)
    SELECT r.doc_id, r.source, p.share, p.phase, r.block,
           p.start + p.b * {mixing.PERIOD} // p.share AS release,
           p.start + ((p.b + 1) * {mixing.PERIOD} + p.share - 1) // p.share AS deadline,
           CAST(p.slot AS BIGINT) AS slot, true AS in_mix
    FROM ranked r JOIN weighed s ON r.source IS NOT DISTINCT FROM s.src
    JOIN places p ON p.rank = s.rank AND p.block = r.block"""


def _leaf_sql(text: str) -> str:
    fields = [f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in (
        "CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)]
    return f"sha256({' || '.join(fields)})"


#: The climb of nodes ``{of}`` (id, tree, idx, fold, path) through ``runs`` of one tree.
_CLIMB_SQL = """
        SELECT * FROM {of}
        UNION ALL
        SELECT c.doc_id, c.leaf, c.g, c.tree, c.lv + 1, c.idx // 16,
               sha256(array_to_string(list_transform(r.kids, lambda d, i:
                   CASE WHEN i - 1 = c.idx % 16 THEN c.fold ELSE d END), '')),
               c.path || array_to_string(list_filter(r.kids, lambda d, i: i - 1 <> c.idx % 16), '')
        FROM {name} c JOIN runs r ON c.tree = r.tree AND c.lv = r.lv AND c.idx // 16 = r.run"""

MERKLE_SQL = f"""
    WITH RECURSIVE crc AS (
        SELECT doc_id, xor(list_reduce(string_split(CAST(doc_id AS VARCHAR), ''), lambda c, b:
            list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)),
                        xor(c, CAST(ascii(b) AS BIGINT))), 4294967295), 4294967295) AS crc
        FROM (SELECT DISTINCT doc_id FROM documents)),
    sources AS (
        SELECT source AS src, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g
        FROM (SELECT DISTINCT source FROM documents)),
    leaves AS (
        SELECT doc_id, g, {_leaf_sql("text")} AS leaf,
               {_leaf_sql(f"CASE WHEN crc % 5 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END")} AS claim
        FROM documents JOIN crc USING (doc_id) JOIN sources ON source IS NOT DISTINCT FROM src),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS pos,
               count(*) OVER (PARTITION BY g) AS n FROM leaves),
    low AS (
        SELECT g AS tree, 0 AS lv, pos AS idx, leaf AS d, n AS width FROM placed
        UNION ALL
        SELECT tree, lv + 1, idx // 16, sha256(string_agg(d, '' ORDER BY idx)), (width + 15) // 16
        FROM low WHERE width > 1 GROUP BY tree, lv, idx // 16, width),
    subroots AS (SELECT tree AS g, d FROM low WHERE width = 1),
    top AS (
        SELECT -1 AS tree, 0 AS lv, g AS idx, d, count(*) OVER () AS width FROM subroots
        UNION ALL
        SELECT tree, lv + 1, idx // 16, sha256(string_agg(d, '' ORDER BY idx)), (width + 15) // 16
        FROM top WHERE width > 1 GROUP BY tree, lv, idx // 16, width),
    runs AS (
        SELECT tree, lv, idx // 16 AS run, list(d ORDER BY idx) AS kids
        FROM (SELECT * FROM low UNION ALL SELECT * FROM top) WHERE width > 1 GROUP BY tree, lv, idx // 16),
    begun AS (SELECT doc_id, leaf, g, g AS tree, 0 AS lv, pos AS idx, claim AS fold, '' AS path FROM placed),
    climb AS ({_CLIMB_SQL.format(of="begun", name="climb")}),
    half AS (
        SELECT doc_id, leaf, g, -1 AS tree, 0 AS lv, g AS idx, fold, path FROM climb
        QUALIFY lv = max(lv) OVER (PARTITION BY doc_id)),
    rise AS ({_CLIMB_SQL.format(of="half", name="rise")}),
    ended AS (SELECT * FROM rise QUALIFY lv = max(lv) OVER (PARTITION BY doc_id)),
    roots AS (SELECT d AS root FROM top WHERE width = 1)
    SELECT e.doc_id, e.leaf, s.d AS subroot, root, sha256(e.path) AS proof_sha256,
           e.fold AS folded_root, e.fold = root AS verified
    FROM ended e JOIN subroots s ON e.g = s.g CROSS JOIN roots"""

TOP_K_SQL = """
    WITH whole AS (
        SELECT row_number() OVER () AS row, vec_id,
               list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.row <> c.row)
    SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
    WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER w <= 10"""

PHRASES_SQL = f"""
    WITH pieces AS (
        SELECT lang, row_number() OVER () AS piece_id, piece FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
    split AS (SELECT lang, piece_id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    single AS (SELECT lang, piece_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM split),
    four AS (
        SELECT lang, a, lead(a, 1) OVER p AS b, lead(a, 2) OVER p AS c, lead(a, 3) OVER p AS d
        FROM single WINDOW p AS (PARTITION BY lang, piece_id ORDER BY i)),
    grams AS (
        SELECT lang, 1 AS k, a AS g FROM four
        UNION ALL SELECT lang, 2, a || ' ' || b FROM four WHERE b IS NOT NULL
        UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c FROM four WHERE c IS NOT NULL
        UNION ALL SELECT lang, 4, a || ' ' || b || ' ' || c || ' ' || d FROM four WHERE d IS NOT NULL),
    counts AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
    often AS (SELECT * FROM counts WHERE f >= {phrases.LEAST}),
    found AS (SELECT lang, g, string_split(g, ' ') AS w, f AS a FROM often WHERE k > 1),
    halves AS (
        SELECT lang, g, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, len(w))) AS k FROM found)),
    cuts AS (
        SELECT h.lang, h.g, h.a, h.k, l.f AS l, r.f AS r,
               CAST({phrases.SCALE} * CAST(h.a AS HUGEINT) // (l.f + r.f) AS BIGINT) AS score
        FROM halves h JOIN often l ON l.lang = h.lang AND l.g = h.head
        JOIN often r ON r.lang = h.lang AND r.g = h.tail),
    weakest AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    within AS (
        SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS g, max(a) AS longer
        FROM (SELECT *, unnest(range(1, len(w))) AS i FROM found), (VALUES (2), (3)) t(k)
        WHERE k < len(w) AND i + k - 1 <= len(w) GROUP BY 1, 2),
    kept AS (
        SELECT w.* FROM weakest w LEFT JOIN within i ON w.lang = i.lang AND w.g = i.g
        WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < {phrases.WITHIN} * CAST(a AS HUGEINT))
    SELECT lang, row_number() OVER p AS rank, g AS phrase, a, l, r, n, score FROM kept JOIN totals USING (lang)
    WINDOW p AS (PARTITION BY lang ORDER BY score DESC, a DESC, g)
    QUALIFY row_number() OVER p <= {phrases.TOP}"""

SQL = {"op13_phrase_collocations": PHRASES_SQL, "op12_ball_tree_top_k": TOP_K_SQL, "op4_pfair_mixing": MIX_SQL, "op9_line_windows": LINES_SQL, "op11_merkle_manifest": MERKLE_SQL}
