"""The registered queries of this subpackage: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation -1 says the template's own control strings."""
    from eventloom.llm.chat import formatted, read_back, threads

    says = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return read_back(formatted(threads(turns, nulls=True), unique=True)).withColumnRenamed("tree", "conv_id")


def op3_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.scoring import scored

    return scored(_table(spark, sf_dir, "documents"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.embeddings import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.packing import packed

    return packed(_table(spark, sf_dir, "documents"), _tokenizer())


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.substring import deduplicated

    return deduplicated(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.common import new_folder
    from eventloom.llm.store import read_digests, write_store

    path = new_folder(spark, "token-store")
    write_store(_table(spark, sf_dir, "documents"), path, _tokenizer())
    return read_digests(spark, path)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.toxicity import fit, scored

    docs = _table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, _table(spark, sf_dir, "labels")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.decontamination import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.sharding import assign

    return assign(_table(spark, sf_dir, "documents"))


def _planted(doc_id: int | None, own: list[bytes]) -> list[bytes]:
    """Of a tenth of the documents, chosen by the id's checksum, the words from one place on become repeats of those that follow it; never of a null id."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not own:
        return own
    n, g = len(own), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    return own[:a] + own[a : a + p] * times + own[a : a + rest]


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.periodic import periodic_runs

    found = periodic_runs(_table(spark, sf_dir, "documents"), alter=_planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period", F.expr("length * 1000 div period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from eventloom.llm.byte_bpe import decoded, encoded

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = decoded(encoded(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.llm.whitening import whitened

    return whitened(_table(spark, sf_dir, "embeddings"))


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_simhash, op2_chat, op3_scoring, op4_embeddings, op5_packing, op6_substring, op7_store, op8_toxicity, op9_decontamination, op10_sharding, op11_periodic, op12_byte_bpe, op13_whitening)}


_CHAT_SQL = r"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g')) + CASE role WHEN 'user' THEN 16 ELSE 15 END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

_EMBEDDINGS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS x, vec_id AS c FROM v UNION SELECT l.x, r.c FROM r JOIN l ON l.y = r.x),
m AS (SELECT x, min(c) AS c FROM r GROUP BY x), n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, m.c AS component_id, v.vec_id = m.c AS kept FROM v JOIN m ON m.x = v.vec_id LEFT JOIN n ON n.x = v.vec_id"""

_SUBSTRING_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS k FROM p),
m AS (SELECT k, min(doc_id) AS d FROM g GROUP BY k),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN m USING (k) WHERE m.d < g.doc_id),
u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
k AS (SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.i) FILTER (c.i IS NULL) AS kept, count(c.i) AS n FROM u LEFT JOIN c ON c.doc_id = u.doc_id AND c.i = u.i GROUP BY u.doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON k.doc_id = w.doc_id"""


def oracle_sql() -> dict[str, str]:
    """Where SQL can say it and is fast enough over whole tables; the other queries are held against brute force in tests/llm."""
    return {"op2_chat": _CHAT_SQL, "op4_embeddings": _EMBEDDINGS_SQL, "op6_substring": _SUBSTRING_SQL}
