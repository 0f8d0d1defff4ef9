"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame.

Every query applies its operator, with the parameters of the operator module,
to the whole table; ``LLM_ORACLE_SQL`` holds the DuckDB statements for those that SQL can express.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlake.session import workers_find_package


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return workers_find_package(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into the token store and read the files back."""
    import public_tokenizers

    from sensorlake.llm.token_store import scan_store, write_store

    store = write_store(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return scan_store(spark, store)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the ones that are not held out."""
    from sensorlake.llm.langid import identify

    return identify(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of all documents."""
    from sensorlake.llm.pii import find

    return find(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of all documents and the verdict of the learned decision list."""
    from sensorlake.llm.quality_rules import quality

    return quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and recurrent-network log10 probability of every whole text."""
    from sensorlake.llm.gru_lm import score_documents

    return score_documents(documents(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 200-byte strings that start more than once."""
    from sensorlake.llm.suffix_dedup import remove_repeats

    return remove_repeats(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every document."""
    from sensorlake.llm.packing import pack

    return pack(documents(spark, sf_dir))


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as tool exchanges: calls linked, ordered, validated and serialised."""
    from sensorlake.llm.tool_calls import EXCHANGE, as_tool_messages, link_tool_calls

    return link_tool_calls(as_tool_messages(documents(spark, sf_dir, "conversations")), EXCHANGE)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by 4-word shingle sets of similarity 0.8 or more."""
    from sensorlake.llm.chosen_path import near_duplicates

    return near_duplicates(documents(spark, sf_dir), k=4)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the measured overlaps."""
    from sensorlake.llm.decontaminate import contaminated

    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings projected on the leading components of their distinct integer vectors, to unit variance."""
    from sensorlake.llm.whitening import whiten

    return whiten(documents(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared prefix of all rebuilt conversations, with members, leaves and savings."""
    from sensorlake.llm.prefix_trie import prefix_trie

    return prefix_trie(documents(spark, sf_dir, "conversations"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint of every whole text and groups of fingerprints within four bits."""
    from sensorlake.llm.simhash import simhash_groups

    return simhash_groups(documents(spark, sf_dir))


LLM_QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_langid": op2_langid,
    "op3_pii": op3_pii,
    "op4_quality_rules": op4_quality_rules,
    "op5_lm_score": op5_lm_score,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_packing": op7_packing,
    "op8_tool_calls": op8_tool_calls,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_decontaminate": op10_decontaminate,
    "op11_whitening": op11_whitening,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_simhash": op13_simhash,
}

LLM_ORACLE_SQL: dict[str, str] = {
    "op6_suffix_dedup": r"""
        WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        win AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS s FROM (
          SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 199, 0))) AS i FROM h)),
        hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS c FROM win) WHERE c > 1),
        runs AS (
          SELECT doc_id, min(i) AS lo, max(i) + 200 AS hi FROM (
            SELECT doc_id, i, sum(CASE WHEN i > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (
              SELECT doc_id, i, lag(i, 1, -1000000) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM hit))
          GROUP BY doc_id, g),
        gone AS (SELECT doc_id, sum(hi - lo) AS removed, count(*) AS spans, list(lo ORDER BY lo) AS lo, list(hi ORDER BY lo) AS hi FROM runs GROUP BY doc_id)
        SELECT h.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
          sha256(unhex(CASE WHEN spans IS NULL THEN h ELSE array_to_string([substr(h, 2 * k[1] + 1, 2 * (k[2] - k[1])) for k in list_zip([0] || hi, lo || [len(h) // 2])], '') END)) AS kept_sha256
        FROM h LEFT JOIN gone g ON g.doc_id = h.doc_id""",
    "op9_near_duplicates": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sh AS (
          SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS s
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        links AS (
          SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id != y.doc_id GROUP BY ALL) p
          JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
        comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN comp c ON c.doc_id = d.doc_id""",
    "op8_tool_calls": """
        WITH m AS (SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, coalesce(text, '') AS text FROM conversations),
        calls AS (
            SELECT conv_id, turn, conv_id || ':' || turn AS call_id, text,
                   CASE role WHEN 'user' THEN 'reply' ELSE 'configure' END AS name,
                   role = 'user' AND EXISTS (SELECT 1 FROM m s WHERE s.conv_id = m.conv_id AND s.role = 'system' AND s.turn = 0) AS waits
            FROM m WHERE role IN ('user', 'system')),
        results AS (
            SELECT conv_id, turn, conv_id || ':' || (turn - 1) AS call_id, text FROM m WHERE role = 'assistant'),
        answers AS (
            SELECT call_id, count(*) AS n_results, arg_min(text, turn) AS content FROM results GROUP BY call_id),
        linked AS (
            SELECT c.*, a.n_results, a.content,
                   CASE WHEN name = 'reply' AND (length(text) = 0 OR length(text) > 1200) THEN 'invalid_arguments'
                        WHEN a.n_results IS NULL THEN 'missing_result' ELSE 'ok' END AS status
            FROM calls c LEFT JOIN answers a USING (call_id))
        SELECT conv_id, call_id, turn, name, status, (CASE WHEN waits THEN 1 ELSE 0 END)::BIGINT AS level,
               coalesce(n_results, 0)::BIGINT AS n_results,
               '{"arguments":{"text":' || to_json(text)::VARCHAR || CASE WHEN name = 'reply' THEN ',"turn":' || turn ELSE '' END || '},"id":"' || call_id
                   || '","name":"' || name || '","result":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"status":"' || status || '"}' AS record
        FROM linked
        UNION ALL
        SELECT r.conv_id, r.call_id, r.turn, NULL, 'orphan_result', NULL, 1,
               '{"arguments":null,"id":"' || r.call_id || '","name":null,"result":' || to_json(r.text)::VARCHAR || ',"status":"orphan_result"}'
        FROM results r WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.call_id = r.call_id)""",
    "op12_prefix_trie": """
        WITH t AS (
          SELECT conv_id, h, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h) AS pos FROM (
            SELECT conv_id::BIGINT AS conv_id, turn, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
              strlen(coalesce(text, ''))::BIGINT AS n FROM conversations WHERE conv_id IS NOT NULL)),
        ids AS (
          SELECT c, c - c % 5 AS b, (xor(list_reduce(list_concat([4294967295::UBIGINT], [ascii(x)::UBIGINT FOR x IN string_split(c::VARCHAR, '')]),
            lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::UBIGINT FOR i IN range(8)]),
              lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)), 4294967295::UBIGINT) % 9)::BIGINT AS h
          FROM (SELECT DISTINCT conv_id AS c FROM t)),
        heads AS (SELECT c, pos AS d, t.h AS x, n FROM ids JOIN t ON t.conv_id = b WHERE pos <= ids.h),
        taken AS (SELECT c, max(d) AS k FROM heads GROUP BY c),
        r AS (
          SELECT c, 0 AS d, '' AS x, 0 AS n FROM ids UNION ALL SELECT * FROM heads
          UNION ALL SELECT ids.c, pos - ids.h + coalesce(k, 0), t.h, t.n FROM ids JOIN t ON t.conv_id = ids.c LEFT JOIN taken ON taken.c = ids.c WHERE pos > ids.h),
        p AS (SELECT c, d, n, string_agg(x, '') OVER (PARTITION BY c ORDER BY d) AS p FROM r),
        nodes AS (SELECT p, min(c) AS conv_id, max(d) AS depth, count(*) AS n_convs, max(n) AS n FROM p GROUP BY p),
        kids AS (SELECT left(p, len(p) - 32) AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
        sub AS (
          SELECT left(p, 32 * i) AS p, sum(leaf)::BIGINT AS n_leaves, sum(gain)::BIGINT AS saved FROM (
            SELECT nodes.p, unnest(range(0, depth + 1)) AS i, CASE WHEN kids.p IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * nodes.n AS gain
            FROM nodes LEFT JOIN kids ON kids.p = nodes.p) GROUP BY ALL),
        ends AS (SELECT p, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (SELECT c, arg_max(p, d) AS p FROM p GROUP BY c) GROUP BY p)
        SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, nodes.n_convs::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children, n_leaves,
          saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM nodes JOIN sub ON sub.p = nodes.p LEFT JOIN kids ON kids.p = nodes.p LEFT JOIN ends ON ends.p = nodes.p
          LEFT JOIN nodes up ON nodes.depth > 0 AND up.p = left(nodes.p, len(nodes.p) - 32)""",
}
