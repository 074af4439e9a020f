"""The operators as queries over the given tables, and their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableprep.llm import align, chat, lexical, licenses, mixing, packing, pii, quality, simjoin, syncmers, tokens, topk, toxicity
from tableprep.llm.common import documents

WORD_BPE, BYTE_BPE, PIECE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = topk.integer_vectors(documents(spark, sf_dir, "embeddings"))
    return topk.top_k(v, v.where("vec_id % 50 = 0"), 5)


def preference_turns(turns: DataFrame) -> DataFrame:
    """Stand-in preferences: beside each conversation c one with the id -1-c, which ends
    in the last turn's text of conversation c+1 (or in its own text, marked)."""
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("turn"))
    ends = turns.join(last, ["conv_id", "turn"], "left_semi").groupBy("conv_id").agg(F.min("text").alias("end")).select((F.col("conv_id") - 1).alias("conv_id"), "end")
    other = (turns.join(last.withColumnRenamed("turn", "last"), "conv_id").join(ends, "conv_id", "left")
             .withColumn("text", F.when(F.col("turn") == F.col("last"), F.coalesce("end", F.concat("text", F.lit(" (no)")))).otherwise(F.col("text"))))
    return turns.select("conv_id", "turn", "role", "text").unionByName(other.select((-1 - F.col("conv_id")).alias("conv_id"), "turn", "role", "text"))


def op3_format_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = chat.conversations(preference_turns(documents(spark, sf_dir, "conversations")))
    pairs = convs.where("conv_id >= 0").select(F.col("conv_id").alias("chosen_id"), (-1 - F.col("conv_id")).alias("rejected_id"))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    out = chat.format_preferences(convs, pairs)
    return out.withColumn("chosen_mask", spans(F.col("chosen_mask"))).withColumn("rejected_mask", spans(F.col("rejected_mask")))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokens.token_folder(spark)
    tokens.write_token_files(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), folder, 2)
    return tokens.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    order = F.create_map(*[F.lit(x) for k, kind in enumerate([*pii.KINDS, *(f"context_{k}" for k in pii.KINDS)]) for x in (kind, k)])
    both = F.array_sort(F.transform(F.concat("base", "extra"), lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("k"), s["end"].alias("end"), s["kind"].alias("kind"))))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return pii.extract(documents(spark, sf_dir)).select(
        "doc_id", *[count(k) for k in pii.KINDS], F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(both).alias("spans"), F.size("extra").cast("long").alias("n_context"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, documents(spark, sf_dir, "labels")))


def op7_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, documents(spark, sf_dir, "labels")))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), 1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simjoin.similar_groups(documents(spark, sf_dir))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(documents(spark, sf_dir)))


def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_exact_top_k, op3_format_preferences, op4_token_files, op5_personal_data,
                                   op6_quality, op7_syncmers, op8_toxicity, op9_pack, op10_ngram_join,
                                   op11_license_scan, op12_align_tokenizers, op13_ranked_search)}
ORACLES: dict[str, str] = {
    "op2_exact_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
             r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op13_ranked_search": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
             d AS (SELECT doc_id, len(t) AS n, t FROM w WHERE len(t) > 0),
             c AS (SELECT count(*) AS n_docs, sum(n) AS n_words FROM d),
             m AS (SELECT doc_id, t, CAST(100 - 25 + ((25 * n * n_docs) // n_words) AS BIGINT) AS m FROM d, c),
             p AS (SELECT doc_id, m, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, m, unnest(t) AS term FROM m) GROUP BY ALL),
             f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
             x AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM f, c),
             q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
             s AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
                   FROM q JOIN x USING (term) JOIN p USING (term) GROUP BY item_id, doc_id),
             r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20""",
}
