"""One query per operator of this folder, over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeflow.llm import chat, decontam, html_blocks, jaccard_join, langid, packing, pivots, prefix_trie, repair, sharding, token_count, toxicity, warc
from swipeflow.llm.common import table
from swipeflow.session import scratch_dir

#: Both turns of the extra conversation of ``op5_chat``.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"
SHARDS = 40


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, f"warc-{uuid.uuid4().hex}")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    return warc.read_warc(spark, folder, payload=False)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn_profiles(docs))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    rows = given.unionByName(extra).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.digest(chat.format_conversations(rows))


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_similar(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.link_vectors(table(spark, sf_dir, "embeddings"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return repair.repair_report(repair.damaged(given), given.select("conv_id"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(*prefix_trie.rebuilt_with_shared_heads(table(spark, sf_dir, "conversations")))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_language_id": op2_language_id,
    "op3_html_extraction": op3_html_extraction,
    "op4_toxicity": op4_toxicity,
    "op5_chat": op5_chat,
    "op6_token_count": op6_token_count,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_packing": op8_packing,
    "op9_decontamination": op9_decontamination,
    "op10_embedding_neardup": op10_embedding_neardup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_sharding": op13_sharding,
}


def _nibble_table() -> list[int]:
    """CRC-32 of the sixteen half bytes."""
    out = list(range(16))
    for _ in range(4):
        out = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in out]
    return out


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text, as DuckDB SQL, half a byte at a time."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    once = "xor(xor(c, b) >> 4, {0}[1 + (xor(c, b) & 15)])".format(_nibble_table())
    twice = f"xor(({once}) >> 4, {_nibble_table()}[1 + (({once}) & 15)])"
    return f"xor(list_reduce({data}, lambda c, b: {twice}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _edit(state: str, cost: str, letter: str) -> str:
    """A cost of nine digits and an audit, with one edit put in front."""
    return f"lpad(CAST(CAST(left({state}, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({state}, 10)"


def _stay(state: str, kind: str) -> str:
    """Keep or rerole the turn for a target of class ``kind``; a turn that must go gives the worst value."""
    return f"CASE WHEN gone THEN '999999999' WHEN kind = '{kind}' THEN {_edit(state, 'cut', 'K')} ELSE {_edit(state, '2 + cut', 'R')} END"


_TIES = "left(role, 16), left(text, 64), sha256(octet_length(encode(role)) || ':' || role || text)"

#: Costs by what the target still wants: s0 anything, s1 a pair after s, u pairs or nothing, a an assistant.
_REPAIR_SQL = f"""
        WITH RECURSIVE src AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f
            FROM conversations
        ), d AS (
            SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
                   CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM src WHERE f <> 0
        ), o AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TIES}) AS i, left(role, 1) AS kind,
                   NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
                   NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open
            FROM d
        ), q AS (
            SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
                   lag(kind) OVER (PARTITION BY conv_id ORDER BY i) || kind AS pair
            FROM o
        ), z AS (SELECT *, blank OR dup AS gone, CASE WHEN open THEN 1 ELSE 0 END AS cut FROM q),
        n AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (open AND NOT blank AND NOT dup) AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM z GROUP BY conv_id
        ), dp AS (
            SELECT conv_id, n + 1 AS i, '000000000' AS s0, '000000004II' AS s1, '000000000' AS u, '000000002I' AS a FROM n
            UNION ALL
            SELECT conv_id, i, least(x0, {_edit('a', '2', 'I')}), least(x1, {_edit('a', '2', 'I')}), u, a FROM (
                SELECT *, least(xu, {_edit('xa', '2', 'I')}) AS u, least(xa, {_edit('xu', '2', 'I')}) AS a FROM (
                    SELECT z.conv_id, z.i,
                           least({_edit('p.u', '3', 'D')}, {_stay('p.a', 'u')}) AS xu,
                           least({_edit('p.a', '3', 'D')}, {_stay('p.u', 'a')}) AS xa,
                           least({_edit('p.s1', '3', 'D')}, {_stay('p.a', 'u')}) AS x1,
                           least({_edit('p.s0', '3', 'D')}, {_stay('p.a', 'u')},
                                 CASE WHEN kind = 's' AND NOT gone THEN {_edit('p.s1', 'cut', 'K')} ELSE '999999999' END) AS x0
                    FROM dp p JOIN z ON z.conv_id IS NOT DISTINCT FROM p.conv_id AND z.i = p.i - 1
                ) t1
            ) t2
        ), e AS (SELECT conv_id, CAST(left(s0, 9) AS BIGINT) AS cost, substr(s0, 10) AS audit FROM dp WHERE i = 1),
        l AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM e),
        w AS (
            SELECT conv_id, p, audit[p] AS edit, length(replace(left(audit, p), 'I', '')) AS i, length(replace(substr(audit, p), 'D', '')) % 2 AS odd
            FROM l WHERE audit[p] <> 'D'
        ), h AS (
            SELECT w.conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN odd = 1 THEN 'assistant' ELSE 'user' END || ':' ||
                   CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS h
            FROM w LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.i = w.i AND edit <> 'I' GROUP BY w.conv_id
        )
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM c.conv_id"""

_TRIE_SQL = f"""
        WITH g AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        o AS (
            SELECT conv_id, sha256(octet_length(encode(role)) || ':' || role || text) AS t, octet_length(encode(text)) AS b,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TIES}) AS pos
            FROM g
        ), ids AS (SELECT conv_id, {_crc32('CAST(conv_id AS VARCHAR)')} % 9 AS h, conv_id - conv_id % 5 AS base FROM (SELECT DISTINCT conv_id FROM g)),
        r AS (
            SELECT ids.conv_id, 0 AS side, pos, t, b FROM ids JOIN o ON o.conv_id = base WHERE pos <= h
            UNION ALL SELECT conv_id, 1, pos, t, b FROM ids JOIN o USING (conv_id) WHERE pos > h
        ), s AS (
            SELECT conv_id, coalesce(string_agg(t, '' ORDER BY side, pos), '') AS path, coalesce(list(b ORDER BY side, pos) FILTER (b IS NOT NULL), []) AS bytes
            FROM ids LEFT JOIN r USING (conv_id) GROUP BY conv_id
        ), m AS (SELECT conv_id, path, bytes, unnest(range(0, len(bytes) + 1)) AS d FROM s),
        nodes AS (
            SELECT left(path, 64 * d) AS k, d, min(conv_id) AS conv_id, count(*) AS n, min(CASE WHEN d = 0 THEN 0 ELSE bytes[d] END) AS b,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(bytes) = d), '') AS ends
            FROM m GROUP BY ALL
        ), kids AS (SELECT left(k, 64 * (d - 1)) AS k, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY ALL),
        x AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids USING (k)),
        sub AS (
            SELECT a.k, count(*) FILTER (z.kids = 0) AS leaves, sum((z.n - 1) * z.b) AS saved
            FROM x a JOIN x z ON left(z.k, 64 * a.d) = a.k GROUP BY a.k
        )
        SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n AS n_convs, CAST(x.kids AS BIGINT) AS n_children,
               leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
        FROM x JOIN sub USING (k) LEFT JOIN x up ON x.d > 0 AND up.d = x.d - 1 AND up.k = left(x.k, 64 * (x.d - 1))"""

ORACLE: dict[str, str] = {
    "op11_conversation_repair": _REPAIR_SQL,
    "op12_prefix_trie": _TRIE_SQL,
    "op1_warc": """
        WITH p AS (
            SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
        ), f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
        SELECT page_id, url, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(p.h, 1 + 5 * CAST(i AS INT), 5) AS INT) >> s) & 31), 1)),
                   'string_agg', '')), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p JOIN f ON p.h = f.h""",
    "op5_chat": f"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
            UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
        ), e AS (
            SELECT *, replace(replace(role, '\\', '\\\\'), '<|', '<\\|') AS role_out,
                   replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS text_out
            FROM r
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role_out, text_out)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role_out, text_out) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<|im_start|><|im_sep|><|im_end|>') + length(role_out) + length(text_out)) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op10_embedding_neardup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
        ), good AS (
            SELECT vec_id, e FROM v
            WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)
              AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), link AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95
        ), reach AS (
            SELECT vec_id AS x, vec_id AS y FROM v
            UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
        ), least AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
        n AS (SELECT x, count(*) AS k FROM link GROUP BY x)
        SELECT v.vec_id, CAST(coalesce(n.k, 0) AS BIGINT) AS n_links, least.c AS component_id, v.vec_id = least.c AS kept
        FROM v JOIN least ON least.x = v.vec_id LEFT JOIN n ON n.x = v.vec_id""",
    "op7_jaccard_join": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL
        ), s AS (
            SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5
                THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                ELSE [array_to_string(w, ' ')] END)) AS g
            FROM w WHERE len(w) > 0
        ), size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (
            SELECT x, y FROM pairs JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
            WHERE 5 * k >= 4 * (a.n + b.n - k)
        ), reach AS (
            SELECT doc_id AS x, doc_id AS y FROM documents
            UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
        ), least AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
        n AS (SELECT x, count(*) AS k FROM link GROUP BY x)
        SELECT d.doc_id, least.c AS class_id, CAST(coalesce(n.k, 0) AS BIGINT) AS n_links
        FROM documents d JOIN least ON least.x = d.doc_id LEFT JOIN n ON n.x = d.doc_id""",
    "op13_sharding": f"""
        WITH d AS (
            SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, sha256(coalesce(text, '')) AS h, coalesce(text, '') AS body
            FROM documents
        ), r AS (
            SELECT *, CAST(sum(size) OVER o - size AS HUGEINT) AS a, CAST(sum(size) OVER o AS HUGEINT) AS b, row_number() OVER o - 1 AS pos
            FROM d WINDOW o AS (ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)
        ), t AS (SELECT max(b) AS total, max(size) AS largest FROM r),
        g AS (SELECT h, min(a) AS ga, max(b) AS gb FROM r GROUP BY h),
        k AS (SELECT unnest(range(1, {SHARDS})) AS k),
        c AS (
            SELECT k.k,
                   least(abs({SHARDS} * ga - k.k * total), abs({SHARDS} * gb - k.k * total)) AS off,
                   CASE WHEN abs({SHARDS} * ga - k.k * total) <= abs({SHARDS} * gb - k.k * total) THEN ga ELSE gb END AS near_group,
                   CASE WHEN abs({SHARDS} * a - k.k * total) <= abs({SHARDS} * b - k.k * total) THEN a ELSE b END AS near_row,
                   total, largest
            FROM k, t, r JOIN g USING (h) WHERE {SHARDS} * a <= k.k * total AND k.k * total < {SHARDS} * b
        ), cuts AS (
            SELECT k, max(CASE WHEN 2 * off <= {SHARDS} * largest AND 200 * off <= total THEN near_group ELSE near_row END) OVER (ORDER BY k) AS cut FROM c
        ), placed AS (
            SELECT r.*, (SELECT count(*) FROM cuts WHERE cut <= r.a) AS shard FROM r
        )
        SELECT doc_id, CAST(size AS BIGINT) AS size, CAST({_crc32("body")} AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INT) AS shard,
               CAST(pos - min(pos) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
        FROM placed""",
}
