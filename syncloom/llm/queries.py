"""The registered queries: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from syncloom.llm import (
    decontamination,
    fill_middle,
    jaccard_join,
    licenses,
    line_dedup,
    mixing,
    personal_data,
    prefix_trie,
    quality_model,
    quality_rules,
    quotes,
    sharding,
    token_blocks,
)
from syncloom.llm.common import Scratch, count_white_words

Query = Callable[[SparkSession, str], DataFrame]

N_SHARDS = 40
MIX_CYCLE = (5.0, 2.0, 1.0)
MIX_TOTAL, MIX_EPOCHS = 1.5, 2.0
VOCABULARY, END_ID = "byte_bpe_50k.json", 2
GOOD_SCORE = 0.3
#: Conversations of a run of OPENING_SPAN ids begin like its first one, for OPENING_MOST - 1 turns at most.
OPENING_SPAN, OPENING_MOST = 20, 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return sharding.shard(docs, N_SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = licenses.known_texts(spark)
    found = licenses.scan(docs, known, unit=licenses.UNITS)
    return found.select(
        "doc_id",
        "licenses.n_matches",
        F.array_join(F.col("licenses.licenses"), ",").alias("licenses"),
    )


def op3_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = f"{Scratch(spark, 'tokens').root}/segments"
    token_blocks.write_tokens(docs, path, partial(public_tokenizers.path, VOCABULARY), END_ID)
    return token_blocks.read_documents(spark, path)


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = Scratch(spark, "quality").write(quality_model.featurised(docs), "features")
    held_out = quality_model.held_out(F.col("doc_id"))
    trusted = table(spark, sf_dir, "labels").where(~held_out & (F.col("quality") == 1))
    model = quality_model.fit_features(rows.where(~held_out), trusted.select("doc_id"))
    return quality_model.score_features(rows, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= GOOD_SCORE).cast("int").alias("predicted"),
    )


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = jaccard_join.similar(docs)
    return found.select(
        "doc_id", "similar.n_shingles", F.col("similar.component").alias("component_id")
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"),
        c["contaminated"].alias("contaminated"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", count_white_words(F.col("text")).alias("size")
    )
    docs = mixing.staged(docs)
    sizes = mixing.source_sizes(docs, "source", F.col("size"))
    weights = mixing.cyclic_weights(sizes, MIX_CYCLE)
    mixed = mixing.mix(
        docs, weights, size=F.col("size"), total=MIX_TOTAL, max_epochs=MIX_EPOCHS
    )
    return mixed.select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "source"
    )


def quoting(messages: DataFrame) -> DataFrame:
    """The conversations as a mailing list would have them: from its second turn on, a message quotes
    one of the two before it above its own words, with what that one quoted, three deep.

    Messages whose turn is a multiple of four leave out the words they reply to and keep the deeper
    quotes. Texts are wrapped anew where they are quoted.
    """
    text = F.coalesce("text", F.lit(""))
    # A blank at a third of all places becomes the end of a line.
    wrapped = F.regexp_replace(text, r"(\S+ \S+) (\S+) ", "$1\n$2 ")
    quoted = lambda c, marks: F.concat(F.lit(marks), F.replace(c, F.lit("\n"), F.lit("\n" + marks)))
    base = messages.where("conv_id is not null and turn is not null")
    said = base.groupBy("conv_id", "turn").agg(F.min(wrapped).alias("said"))
    above = F.when(F.col("turn") > 0, F.col("turn") - 1 - (F.col("conv_id") % 2) * (F.col("turn") > 1).cast("long"))
    chain = messages.withColumn("_p1", above)
    for k in (1, 2, 3):
        turn = F.col(f"_p{k}")
        other = said.select(
            F.col("conv_id").alias(f"_c{k}"), F.col("turn").alias(f"_t{k}"), F.col("said").alias(f"_s{k}")
        )
        chain = chain.join(
            other, (F.col("conv_id") == F.col(f"_c{k}")) & (turn == F.col(f"_t{k}")), "left"
        ).withColumn(f"_p{k + 1}", F.when(turn > 0, turn - 1 - (F.col("conv_id") % 2) * (turn > 1).cast("long")))
    first = F.when(F.col("turn") % 4 != 0, quoted(F.col("_s1"), "> "))
    parts = [quoted(F.col("_s3"), "> > > "), quoted(F.col("_s2"), ">> "), first, text]
    return chain.select("conv_id", "turn", "role", F.concat_ws("\n", *parts).alias("text"))


def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = Scratch(spark, "mail").write(quoting(table(spark, sf_dir, "conversations")), "messages")
    found = quotes.link_quotes(messages)
    return found.select(
        "conv_id",
        "turn",
        "role",
        "reply.reply_to",
        "reply.thread",
        "reply.depth",
        "reply.n_quoted",
        "reply.deepest",
        F.sha2(F.encode("reply.body", "UTF-8"), 256).alias("body_sha256"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge(docs)
    names = (
        "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"
        " n_lines n_stop_words"
    ).split()
    return judged.select("doc_id", *[F.col("quality")[n].alias(n) for n in names])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.line_bitmaps(docs)
    return found.select(
        "doc_id",
        "lines.n_lines",
        "lines.n_dropped",
        F.sha2(F.encode(line_dedup.kept_text(found), "UTF-8"), 256).alias("kept_sha256"),
    )


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = personal_data.fit(docs)
    found = personal_data.find_personal_data(docs, net).select("doc_id", "personal")

    def listed(spans):
        cell = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, cell), ",")

    split = found.select("doc_id", "personal", F.filter("personal", lambda s: s["rule"]).alias("base"))
    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return split.select(
        "doc_id",
        *map(count, personal_data.KINDS),
        F.sha2(F.encode(listed(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        listed(F.col("personal")).alias("spans"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    conversations = prefix_trie.conversations_of(ordered)
    c = F.col("conversation")
    openings = conversations.select(
        c,
        (c - c % OPENING_SPAN).alias("base"),
        (F.crc32(F.encode(c.cast("string"), "UTF-8")) % OPENING_MOST).alias("taken"),
    )
    turns = prefix_trie.with_openings(ordered, openings, OPENING_MOST - 1)
    nodes, ends = prefix_trie.prefix_trie(conversations, turns)
    found = nodes.join(prefix_trie.ends_digests(ends), ["a", "b"], "left")
    return found.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_middle.fill_in_middle(docs).select("doc_id", "fim.*")
    again = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(again, "UTF-8"), 256).alias("restored_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_license_scan": op2_license_scan,
    "op3_token_blocks": op3_token_blocks,
    "op4_quality_model": op4_quality_model,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_mixing": op7_mixing,
    "op8_quotes": op8_quotes,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_personal_data": op11_personal_data,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": pipeline,
}
