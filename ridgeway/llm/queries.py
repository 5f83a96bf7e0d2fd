"""The queries opN_<name> of this subpackage: each applies its operator with production
parameters to whole tables and derives the digest columns from the operator's output."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.llm import bpe_stream, chat_format, decontaminate, divergence, html_crf, html_samples, near_dedup, ns_kmeans, oracles, quality_rff, secrets, source_mix, token_arrow, warc, whitening

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_sha256(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


@query("op1_rff_quality")
def op1_rff_quality(spark, sf_dir):
    features = quality_rff.featurise(table(spark, sf_dir, "documents"))
    return quality_rff.score(features, quality_rff.fit(features, table(spark, sf_dir, "labels")))


@query("op2_chat_format", oracles.CHAT_FORMAT)
def op2_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = (spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")))
    out = chat_format.format_chats(rows.unionByName(probe))
    back = out.select("conv_id", chat_format.read_turns(F.col("formatted")).alias("turns"),
                      chat_format.read_loss(F.col("pieces")).alias("loss"), "formatted")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), hex_sha256(told).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), hex_sha256(F.col("loss")).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


@query("op3_warc_normaliser", oracles.WARC)
def op3_warc_normaliser(spark, sf_dir):
    manifest, folder = warc.write(table(spark, sf_dir, "pages"))
    back = warc.read(warc.normalise(manifest, folder), folder)
    return back.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))


@query("op4_chosen_path_dedup", oracles.NEAR_DEDUP)
def op4_chosen_path_dedup(spark, sf_dir):
    return near_dedup.deduplicate(table(spark, sf_dir, "documents"))


@query("op5_distribution_divergence")
def op5_distribution_divergence(spark, sf_dir):
    return divergence.score(table(spark, sf_dir, "documents"))


@query("op6_markov_secrets")
def op6_markov_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(secrets.samples(docs)))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        hex_sha256(secrets.spans_text(F.col("base"))).alias("base_sha256"),
                        secrets.spans_text(F.col("spans")).alias("spans"))


@lru_cache(maxsize=1)
def block_model():
    """Trained once per driver; the training pages are made by rule."""
    return html_crf.train(html_samples.labelled_pages())


@query("op7_html_crf")
def op7_html_crf(spark, sf_dir):
    return html_crf.extract(table(spark, sf_dir, "pages"), block_model())


@query("op8_benchmark_decontamination", oracles.DECONTAMINATION)
def op8_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"),
                        F.size("item_ids").cast("long").alias("n_items"),
                        hex_sha256(F.array_join("item_ids", ",")).alias("items_sha256"), "contaminated")


def ids_sha256(ids: pa.Array, step: int = 1 << 20) -> str:
    """Digest of the decimal ids with one space between, ``step`` of them at a time."""
    digest = hashlib.sha256()
    for lo in range(0, len(ids), step):
        part = ids.slice(lo, step).cast(pa.string())
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part), " ")[0]
        digest.update(b" " if lo else b"")
        digest.update(joined.as_buffer())
    return digest.hexdigest()


def bpe_digests(batch):
    """Digest columns of a batch of encoded documents (id, ids, decoded)."""
    ids, decoded = batch.column("ids"), batch.column("decoded")
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), ids.value_lengths().cast(pa.int64()),
         pa.array([ids_sha256(x.values) for x in ids], pa.string()),
         pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in decoded], pa.string())],
        names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])


@query("op9_streaming_bpe")
def op9_streaming_bpe(spark, sf_dir):
    return bpe_stream.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                             digest=bpe_digests, digest_schema="n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op10_token_arrow")
def op10_token_arrow(spark, sf_dir):
    index, folder = token_arrow.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_arrow.read(index, folder, digest=token_arrow.crc32, digest_schema="ids_crc32")


@query("op11_source_mix", oracles.SOURCE_MIX)
def op11_source_mix(spark, sf_dir):
    return source_mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op12_qdwh_whitening")
def op12_qdwh_whitening(spark, sf_dir):
    """The deviation is null where it is no long (from about 10^9 distinct vectors on); the operator's own is exact."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


@query("op13_ns_kmeans", oracles.NS_KMEANS)
def op13_ns_kmeans(spark, sf_dir):
    return ns_kmeans.cluster(table(spark, sf_dir, "embeddings"))
