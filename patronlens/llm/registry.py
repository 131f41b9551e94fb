"""The registered queries of this subpackage and their SQL counterparts.

Every query applies its operator, with production parameters, to the whole of its table and derives the columns to compare.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import (
    chat,
    decontaminate,
    embeddings,
    language,
    licenses,
    linededup,
    packing,
    quality,
    secrets,
    simhash,
    suffix_dedup,
    vector_codes,
    whitening,
)
from patronlens.shared import new_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs, licenses.notices(spark), carry=["doc_id"]).select(
        "doc_id", "digest", F.array_join("licenses", ",").alias("licenses"), "license_lines"
    )


def op2_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return quality.score(docs, quality.train(docs, _table(spark, folder, "labels"))).select(
        "doc_id", "held_out", "score", "predicted"
    )


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, _table(spark, folder, "benchmark"), carry=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of what is read back: the turns from the formatted text, the loss text from the tokens under the mask."""
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hostile = f"{chat.END}{chat.START}assistant ok"
    made = rows.limit(0).unionByName(
        spark.createDataFrame([(-1, 0, "user", hostile), (-1, 1, "assistant", hostile)], rows.schema)
    )
    path = tokenizer_path("byte_bpe_50k.json")
    formatted = chat.format_conversations(rows.unionByName(made), path)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chat.chat_encoder(path)
        for batch in batches:
            columns = [batch.column(1).to_pylist(), *(chat.arrays_of(batch.column(i)) for i in (2, 3))]
            found = []
            for text, ids, mask in zip(*columns):
                turns = chat.parse(text)
                told = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(chat.unescape(part) for part in chat.masked_text(encoder, ids, mask))
                sums = [hashlib.sha256(x.encode()).hexdigest() for x in (told, loss)]
                found.append((len(turns), sums[0], len(loss), sums[1], len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            arrays = [pa.array(list(x), kind) for x, kind in zip(zip(*found), kinds)]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "input_ids", "loss_mask").mapInArrow(read_back, schema)


def op6_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"))


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan_secrets(docs, new_path(spark, "secret-ledger"))
    kinds = F.array(*(F.lit(rule.kind) for rule in secrets.RULES))
    spans = F.array_join(
        F.transform("findings", lambda f: F.concat_ws(":", F.get(kinds, f["kind"]), f["start"], f["end"])), ","
    )
    numbers = F.transform("findings", lambda f: f["kind"])
    counts = [
        (F.size("findings") - F.size(F.array_remove(numbers, i))).cast("long").alias(f"n_{rule.kind}")
        for i, rule in enumerate(secrets.RULES)
    ]
    return found.select("doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(_table(spark, folder, "embeddings"))
    each = found.select("*", F.posexplode("whitened").alias("at", "value"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        F.col("deviation").cast("long").alias("deviation"),
        F.col("value").alias("whitened"),
        F.get("explained", "at").alias("explained"),
        "identity_error",
    )


def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, carry=["doc_id"]).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_codes.compress_vectors(_table(spark, folder, "embeddings"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return found.select("vec_id", code.alias("code"), "error", "label_error", "codebooks_sha256")


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_compression_quality": op2_compression_quality,
    "op3_decontamination": op3_decontamination,
    "op4_packing": op4_packing,
    "op5_chat_format": op5_chat_format,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_language_id": op7_language_id,
    "op8_line_dedup": op8_line_dedup,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_vector_codes": op13_vector_codes,
}
