"""The training-data queries: one ``opN_<name>`` per operator, each over its
whole table with production parameters. Thin: the operators have their own
interfaces, and the digest columns are derived from their outputs here."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import (
    blocks, bpe, chat, embed_dedup, hard_negatives, html_extract, langid, minhash, mixing,
    neighbours, ngram_join, secrets, spelling, url_filter,
)
from rillflow.llm.common import batch_rows, read_table, with_next
from rillflow.llm.oracles import ORACLES
from rillflow.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

URL_RULES: list[url_filter.Rule] = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/")]


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


@register
def op1_url_filter(spark, sf_dir):
    return url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES,
                            url_filter.default_model(spark))


def _span_list(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@register
def op2_secret_scan(spark, sf_dir):
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    base = {r.kind for r in secrets.BASE_RULES}

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in secrets.BASE_RULES],
        F.sha2(_span_list(F.filter("spans", lambda s: s["kind"].isin(*base))), 256)
        .alias("base_sha256"),
        _span_list(F.col("spans")).alias("spans"))


@register
def op8_mixing(spark, sf_dir):
    sized = mixing.measure(read_table(spark, sf_dir, "documents"))
    return mixing.drawn(sized, *mixing.plan_mix(sized)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.size("draws")).alias("taken"))


#: bytes of a conversation that is digested in one row
WHOLE_BYTES = 32_000_000
#: windows in an Arrow batch
_WINDOWS = 256


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest row of each conversation from its windows, which come in order."""
    conv, now = None, None

    def row():
        turns, loss = now["turns"].hexdigest(), now["loss"].hexdigest()
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], kind), *map(pa.array, ([now["n"]], [turns], [now["loss_chars"]],
                                                     [loss], [now["chars"]]))],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                   "formatted_chars"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for r in batch.to_pylist():
            if now is None or r["conv_id"] != conv:
                if now is not None:
                    yield row()
                conv = r["conv_id"]
                now = {"turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0,
                       "loss_chars": 0, "chars": 0}
            now["turns"].update(r["turns"].encode())
            now["loss"].update(r["loss"].encode())
            now["n"] += r["n"]
            now["loss_chars"] += len(r["loss"])
            now["chars"] += r["chars"]
    if now is not None:
        yield row()


@register
def op10_chat_format(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("\\### Assistant: </turn> ok")
    more = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"),
                 F.lit(role).alias("role"), text.alias("text"))
        for i, role in enumerate(("user", "assistant"))])))
    turns = turns.unionByName(more)
    # sha2 takes a whole text: conversations too large for a row are digested as streams
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + F.coalesce(
        F.octet_length("role"), F.lit(0)) + 16
    large = materialize(turns.groupBy("conv_id").agg(F.sum(size).alias("bytes"))
                        .where(F.col("bytes") > WHOLE_BYTES)
                        .select(F.col("conv_id").alias("large_id")), "large-conversations")
    if large.isEmpty():
        return _digested_whole(turns)
    same = F.col("conv_id").eqNullSafe(F.col("large_id"))
    return _digested_whole(turns.join(large, same, "left_anti")).unionByName(
        _digested_streams(turns.join(large, same, "left_semi")))


def _windows_read(turns):
    """Each window's turns and loss texts, read back."""
    return chat.windows(turns).select(
        "conv_id", F.struct(
            "window",
            F.size(chat.read_turns(F.col("text"), F.col("n_repeated"))).alias("n"),
            F.array_join(F.transform(
                chat.read_turns(F.col("text"), F.col("n_repeated")),
                lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
            .alias("turns"),
            F.array_join(chat.read_loss(F.col("text"), F.col("loss")), "").alias("loss"),
            F.length("text").alias("chars")).alias("w"))


def _digested_streams(turns):
    kind = dict(turns.dtypes)["conv_id"]
    batch_rows(turns.sparkSession, _WINDOWS)
    return _windows_read(turns).select("conv_id", "w.*").repartition("conv_id") \
        .sortWithinPartitions("conv_id", "window").mapInArrow(
            _digests, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                      "loss_sha256 string, formatted_chars bigint")


def _digested_whole(turns):
    """The digests run over a whole conversation: its windows' texts, joined in order."""
    per = _windows_read(turns).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("w")).alias("w"))
    loss = F.array_join("w.loss", "")
    return per.select(
        "conv_id", F.aggregate("w.n", F.lit(0), lambda a, n: a + n).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("w.turns", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.aggregate("w.chars", F.lit(0).cast("bigint"), lambda a, n: a + n)
        .alias("formatted_chars"))


@register
def op4_minhash(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit(""))
                                                         .alias("text"))
    batch_rows(spark, minhash.BATCH)
    pairs = with_next(docs, "doc_id", "text", "next")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half),
                      F.substring("next", F.lit(1), half))
    prints = pairs.withColumn("edited", edited).select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        minhash.fingerprints("text").alias("fingerprint"),
        minhash.fingerprints("next").alias("next_fingerprint"),
        minhash.fingerprints("edited").alias("edited_fingerprint"))
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        minhash.likenesses("fingerprint", "edited_fingerprint").alias("near_edited"),
        minhash.likenesses("fingerprint", "next_fingerprint").alias("near_next"))


@register
def op5_byte_bpe(spark, sf_dir):
    return bpe.round_trip(read_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


@register
def op6_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~out))
    return langid.identified(docs.drop("lang"), model, "p").select(
        "doc_id", out.alias("held_out"), "p.lang_pred", "p.score")


@register
def op7_embedding_dedup(spark, sf_dir):
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@register
def op9_ngram_join(spark, sf_dir):
    return ngram_join.with_links(read_table(spark, sf_dir, "documents"))


@register
def op3_html_extract(spark, sf_dir):
    return html_extract.extract(read_table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("bigint"))


@register
def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(spelling.words_of(read_table(spark, sf_dir, "documents")))


@register
def op12_hard_negatives(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    return hard_negatives.mine(
        rows.select("vec_id", label.alias("label"),
                    F.when(blocks.usable(F.col("embedding")), whole).alias("embedding")),
        F.col("vec_id") % 100 == 0)


@register
def op13_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
