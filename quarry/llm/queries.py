"""The registered queries of the operators: each applies one to its whole table and derives the asked columns."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (chat, divergence, hard_negatives, html_text, language, minhash, multi_index, packing, pieces, quality_model,
                        quality_rules, substrings, token_counts)
from quarry.llm.common import held_out, tidied
from quarry.sources.tables import read_table

CHAT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
COUNT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PACK_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: A conversation whose texts look like the template.
PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def chat_digests(parts: DataFrame, tokenizer_path: str) -> DataFrame:
    """What the formatted ids and masks hold, read back, by conversation.

    A task reads the parts of a conversation in order and keeps running
    digests only, however long the conversation is.
    """
    with open(tokenizer_path, "rb") as f:
        model = parts.sparkSession.sparkContext.broadcast(f.read())

    def read_back(batches):
        codec = chat.Codec(model.value)
        for b in batches:
            n, turns, loss, chars = [], [], [], []
            for ids, mask, text in zip(b.column("ids").to_pylist(), b.column("loss_mask").to_pylist(), b.column("text").to_pylist(), strict=True):
                own = codec.turns(ids)
                n.append(len(own))
                turns.append("".join(f"{r}\n{t}\n" for r, t in own))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], np.array(mask, np.int8), [0]])))
                loss.append("".join(chat.unescape(codec.decode(ids[s:e])) for s, e in zip(edge[::2], edge[1::2], strict=True)))
                chars.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("part"), pa.array(n, pa.int64()), pa.array(turns, pa.string()),
                 pa.array(loss, pa.string()), pa.array(chars, pa.int64())], ["conv_id", "part", "n", "turns", "loss", "chars"])

    def digest(batches):
        conv, begun = None, False
        n = loss_chars = chars = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()

        def row():
            return pa.RecordBatch.from_pylist([{
                "conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars,
                "loss_sha256": loss.hexdigest(), "formatted_chars": chars}], schema)

        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for b in batches:
            done = []
            for c, k, t, l, m in zip(*(b.column(x).to_pylist() for x in ("conv_id", "n", "turns", "loss", "chars")), strict=True):
                if begun and c != conv:
                    done.append(row())
                    n = loss_chars = chars = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                conv, begun = c, True
                n, loss_chars, chars = n + k, loss_chars + len(l), chars + m
                turns.update(t.encode())
                loss.update(l.encode())
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if begun:
            yield row()

    back = parts.mapInArrow(tidied(read_back), "conv_id bigint, part bigint, n bigint, turns string, loss string, chars bigint")
    return (back.repartition("conv_id").sortWithinPartitions("conv_id", "part")
            .mapInArrow(tidied(digest), "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat formatting of all conversations, read back from ids and loss masks."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id bigint, turn bigint, role string, text string")
    return chat_digests(chat.format_chats(rows.unionByName(planted), CHAT_TOKENIZER), CHAT_TOKENIZER)


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of all documents by the distinct-chunk table, and their decoding."""
    coded = pieces.encode(read_table(spark, sf_dir, "documents"), PIECE_MODEL)
    return pieces.decode(coded, PIECE_MODEL).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of 50-byte strings that start in a document with a smaller id."""
    done = substrings.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s.end - s.start)
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings of one label by the inverted multi-index."""
    return multi_index.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of all documents and the default policy's verdict."""
    led = quality_rules.apply_policy(quality_rules.ledger(read_table(spark, sf_dir, "documents")))
    base = F.col("failed_bits").bitwiseAND(F.lit(quality_rules.policy_mask("base"))) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), "kept", "failed_bits")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out("doc_id")))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by SuperMinHash, banding and verification on full sets."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4,096 ids."""
    packed = packing.pack(read_table(spark, sf_dir, "documents"), PACK_TOKENIZER)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages by the conditional random field."""
    return html_text.extract(read_table(spark, sf_dir, "pages"), html_text.train()) \
        .select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by nearest labelled neighbours."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality_model.fit(docs, read_table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    return quality_model.classify(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ in their terms, over all documents."""
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by rank-synchronous merging."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), COUNT_TOKENIZER)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the labels of every seventh are off by one."""
    label = F.col("label").cast("bigint")
    rows = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0).select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the default policy contributes over all documents."""
    return quality_rules.ablations(quality_rules.ledger(read_table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_chat_format, op2_pieces, op3_repeats, op4_vectors, op5_quality_rules, op6_language, op7_minhash, op8_packing,
    op9_html, op10_quality_model, op11_source_divergence, op12_token_counts, op13_hard_negatives, quality_ablations)}
