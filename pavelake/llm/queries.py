"""Registered queries of this subpackage and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavelake.llm import bpe, dartminhash, decontam, embeddings, langid, licenses, merkle, packing, passages, prefixes, secrets
from pavelake.llm import suffixtree, toxicity
from pavelake.llm.common import fold, held, table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.samples(docs))
    return found.select("doc_id", held("doc_id", 4, 2).alias("held_out"), "language.*")


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digest(passages.repeated(table(spark, sf_dir, "documents")))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proofs = merkle.manifest(table(spark, sf_dir, "documents"), tampered=fold("doc_id", 2) == 0, text=F.translate("text", "\n", ""))
    return merkle.verified(proofs)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(prefixes.rebuilt(prefixes.sequences(table(spark, sf_dir, "conversations"))))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


QUERIES = (op1_minhash_dedup, op2_license_scan, op3_bpe_roundtrip, op4_toxicity, op5_decontamination, op6_embedding_dedup,
           op7_language_id, op8_repeated_passages, op9_secret_scan, op10_lm_scores, op11_merkle_manifest,
           op12_conversation_trie, op13_packing)


def registered() -> dict:
    return {f.__name__: f for f in QUERIES}


def _secret_sql() -> str:
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    mark = "chr(57344)"
    split = "\n        UNION ALL ".join(
        f"SELECT doc_id, source, {k} AS kind, string_split(regexp_replace(body, {quoted(p)}, {mark} || '\\0' || {mark}, 'g'), {mark}) AS parts FROM d"
        for k, (_, p, _) in enumerate(secrets.KINDS))
    value = f"CASE WHEN kind = 0 THEN regexp_extract(piece, {quoted(secrets.ASSIGN)}, 2) ELSE piece END"
    names = "['" + "','".join(k[0] for k in secrets.KINDS) + "']"
    least = "[" + ",".join(str(k[2]) for k in secrets.KINDS) + "]"
    entry = f"{names}[kind + 1] || ':' || s || ':' || e"
    return f"""
    WITH d AS (SELECT doc_id, source, translate(coalesce(text, ''), {mark}, chr(57345)) AS body FROM documents),
    p AS ({split}),
    u AS (SELECT doc_id, source, kind, unnest(parts) AS piece, generate_subscripts(parts, 1) AS i FROM p),
    m AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id, kind ORDER BY i
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM u),
    f AS (SELECT doc_id, coalesce(source, '') AS source, kind, s, s + length(piece) AS e, {value} AS value FROM m WHERE i % 2 = 0),
    g AS (SELECT * FROM f WHERE length(value) >= {least}[kind + 1]),
    o AS (SELECT value FROM g WHERE kind < {secrets.BASE_KINDS} GROUP BY value
          HAVING count(DISTINCT source) < {secrets.OWNERS_OF_AN_EXAMPLE} AND count(DISTINCT doc_id) < {secrets.REPOSITORIES_OF_AN_EXAMPLE}),
    j AS (SELECT g.*, kind >= {secrets.BASE_KINDS} OR value IN (SELECT value FROM o) AS live FROM g),
    a AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
            coalesce(string_agg({entry}, ',' ORDER BY s, kind) FILTER (kind < {secrets.BASE_KINDS}), '') AS base,
            string_agg({entry}, ',' ORDER BY s, kind) AS spans, count(*) FILTER (live) AS n_live,
            coalesce(string_agg({entry}, ',' ORDER BY s, kind) FILTER (live), '') AS live_spans FROM j GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
           coalesce(live_spans, '') AS live_spans
    FROM d LEFT JOIN a USING (doc_id)"""


EMBEDDING_SQL = f"""
    WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
          AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= {embeddings.COSINE}),
    r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
    c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
    n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
    SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
    FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""


def _words_sql(source: str, key: str) -> str:
    return (f"SELECT {key}, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x09-\\x0D\\x20]+'), lambda x: x <> '') AS w "
            f"FROM {source}")


def _runs_sql(source: str, key: str) -> str:
    return (f"SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) "
            f"WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS r FROM {source}")


DECONTAMINATION_SQL = f"""
    WITH dw AS ({_words_sql('documents', 'doc_id')}), bw AS ({_words_sql('benchmark', 'item_id')}),
    d AS ({_runs_sql('dw', 'doc_id')}), b AS ({_runs_sql('bw', 'item_id')}),
    n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id),
    j AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (r) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM j JOIN n USING (item_id)
    WHERE n_shared / n_item >= {decontam.CONTAINED}"""


def _license_sql() -> str:
    rows = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(licenses.TEMPLATES))
    words = "list_filter(string_split_regex(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
    grams = ("CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) "
             "ELSE w END")
    ratio = licenses.DICE / (2 - licenses.DICE)
    return f"""
    WITH t AS (SELECT * FROM (VALUES {rows}) AS x(template, license_id, text)),
    tw AS (SELECT template, license_id, {words.format('text')} AS w FROM t),
    tg AS (SELECT template, license_id, {grams} AS g FROM tw),
    l AS (SELECT doc_id, text, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL),
    b AS (SELECT doc_id, text, string_split_regex(text, '\\n[\\x20\\x09\\x0D]*\\n') AS p FROM documents WHERE text IS NOT NULL),
    u AS (SELECT doc_id, 'line' AS unit, unnest(p) AS part, generate_subscripts(p, 1) - 1 AS place FROM l
          UNION ALL SELECT doc_id, 'block', unnest(p), generate_subscripts(p, 1) - 1 FROM b),
    uw AS (SELECT doc_id, unit, place, {words.format('part')} AS w FROM u WHERE unit = 'line' OR contains(trim(part), chr(10))),
    ug AS (SELECT doc_id, unit, place, {grams} AS g FROM uw),
    s AS (SELECT doc_id, unit, place, license_id, 2 * len(list_intersect(ug.g, tg.g)) / (len(ug.g) + len(tg.g)) AS dice
          FROM ug JOIN tg ON len(ug.g) BETWEEN len(tg.g) * {ratio} - 1e-9 AND len(tg.g) / {ratio} + 1e-9),
    r AS (SELECT *, rank() OVER (PARTITION BY doc_id, unit, place ORDER BY dice DESC) AS n FROM s WHERE dice >= {licenses.DICE})
    SELECT doc_id, unit, place::INTEGER AS place, min(license_id) AS license_id, dice FROM r WHERE n = 1
    GROUP BY doc_id, unit, place, dice"""


def _crc32_sql(value: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit, as DuckDB has no function for it."""
    codes = f"list_transform(string_split({value}, ''), lambda x: ascii(x)::BIGINT)"
    bits = "list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda b, z: xor(b >> 1, (b & 1) * 3988292384), xor(a, c))"
    return f"xor(list_reduce({codes}, lambda a, c: {bits}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _leaf_sql(text: str) -> str:
    def entered(value: str) -> str:
        return f"coalesce(octet_length(encode(({value})::VARCHAR)) || ':' || ({value})::VARCHAR, '-')"

    return "sha256(" + " || ".join(entered(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE_SQL = f"""
    WITH RECURSIVE r AS (SELECT row_number() OVER () AS rid, *, {_leaf_sql('text')} AS leaf,
        CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql('text')} END AS changed FROM documents),
    p AS (SELECT rid, doc_id, leaf, changed, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
            row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos,
            count(*) OVER (PARTITION BY source) AS n FROM r),
    t AS (SELECT 0 AS level, s, pos, n, leaf AS digest FROM p
          UNION ALL SELECT level + 1, s, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM t WHERE n > 1
          GROUP BY level, s, pos // 3, n),
    u AS (SELECT 0 AS level, s AS pos, count(*) OVER () AS n, digest FROM t WHERE n = 1
          UNION ALL SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM u WHERE n > 1
          GROUP BY level, pos // 3, n),
    steps AS (SELECT rid, t.level AS k, string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos < p.pos // (3 ** t.level)::BIGINT) AS lft,
            string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos > p.pos // (3 ** t.level)::BIGINT) AS rgt
          FROM p JOIN t ON t.s = p.s AND t.n > 1 AND t.pos // 3 = p.pos // (3 ** (t.level + 1))::BIGINT GROUP BY ALL
          UNION ALL SELECT rid, 100 + u.level, string_agg(u.digest, '' ORDER BY u.pos) FILTER (u.pos < p.s // (3 ** u.level)::BIGINT),
            string_agg(u.digest, '' ORDER BY u.pos) FILTER (u.pos > p.s // (3 ** u.level)::BIGINT)
          FROM p JOIN u ON u.n > 1 AND u.pos // 3 = p.s // (3 ** (u.level + 1))::BIGINT GROUP BY ALL),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY k) AS i FROM steps),
    f AS (SELECT rid, 0::BIGINT AS i, changed AS digest FROM p
          UNION ALL SELECT f.rid, n.i, sha256(coalesce(lft, '') || digest || coalesce(rgt, '')) FROM f JOIN numbered n ON n.rid = f.rid AND n.i = f.i + 1),
    e AS (SELECT rid, arg_max(digest, i) AS folded_root FROM f GROUP BY rid),
    q AS (SELECT rid, string_agg(coalesce(lft, '') || coalesce(rgt, ''), '' ORDER BY i) AS proof FROM numbered GROUP BY rid)
    SELECT doc_id, leaf, b.digest AS subroot, o.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
           folded_root = o.digest AS verified
    FROM p JOIN e USING (rid) LEFT JOIN q USING (rid) JOIN t b ON b.n = 1 AND b.s = p.s JOIN u o ON o.n = 1"""


TRIE_SQL = f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST,
            sha256(octet_length(encode(role)) || ':' || role || text)) AS turns FROM t GROUP BY conv_id),
    h AS (SELECT *, ({_crc32_sql('conv_id::VARCHAR')} % 4) AS h FROM o),
    b AS (SELECT h.conv_id, coalesce(o.turns[:h.h], []) || h.turns[h.h + 1:] AS turns
          FROM h LEFT JOIN o ON o.conv_id = h.conv_id - h.conv_id % 20),
    m AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM b),
    n AS (SELECT depth, turns[:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
          FROM m GROUP BY depth, turns[:depth]),
    w AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(list_filter(string_split_regex(prefix[depth].text,
            '[\x20\x09-\x0D]+'), lambda x: x <> '')) END AS tokens FROM n),
    c AS (SELECT depth - 1 AS depth, prefix[:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
    k AS (SELECT w.*, coalesce(n_children, 0) AS n_children FROM w LEFT JOIN c ON c.depth = w.depth AND c.prefix = w.prefix),
    a AS (SELECT prefix[:d] AS prefix, d AS depth, sum(tokens)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
          FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM k) GROUP BY prefix[:d], d)
    SELECT k.conv_id, k.depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, k.ends_sha256
    FROM k JOIN a ON a.depth = k.depth AND a.prefix = k.prefix
    LEFT JOIN k u ON u.depth = k.depth - 1 AND u.prefix = k.prefix[:k.depth - 1]"""


def oracles() -> dict[str, str]:
    return {"op2_license_scan": _license_sql(), "op5_decontamination": DECONTAMINATION_SQL, "op6_embedding_dedup": EMBEDDING_SQL,
            "op9_secret_scan": _secret_sql(), "op11_merkle_manifest": MERKLE_SQL, "op12_conversation_trie": TRIE_SQL}
