"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. Equal blocks get the same integer
name by sorting the distinct blocks; then the names of adjacent blocks are paired and the
distinct pairs are named in the same way, until each document has one name. Two texts are
equal exactly if they have the same number of blocks and the same last name.

Blocks are sorted by a 64-bit key first and by their content where two blocks share a key,
so names never collide, and only distinct blocks (combined on the map side) are shuffled with
their bytes. From then on only integers move.

Rows with the same id and digest are one row with a multiplicity until the result is made.
Null text counts as empty; a null id is an id of its own that loses against any other. Only
the two named columns are read, so other columns cannot clash. An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.batches import fold_case
from turnstile.session import stage

BLOCK_BYTES = 4096


def cut_blocks(docs: DataFrame, doc_id: str, text: str, block_bytes: int) -> DataFrame:
    """One row per block: doc_id, digest, n_blocks, pos, block, sort_key."""
    folded = docs.select(F.col(doc_id).alias("doc_id"), fold_case(F.col(text)).alias("folded"))
    sized = folded.select(
        "doc_id", F.unhex(F.sha2("folded", 256)).alias("digest"),
        F.col("folded").cast("binary").alias("raw"),
        F.greatest(F.lit(1), F.ceil(F.octet_length("folded") / block_bytes)).cast("int")
        .alias("n_blocks"))
    return sized.select(
        "doc_id", "digest", "n_blocks", "raw",
        F.explode(F.expr("sequence(0, n_blocks - 1)")).alias("pos"),
    ).select(
        "doc_id", "digest", "n_blocks", "pos",
        F.expr(f"substring(raw, pos * {block_bytes} + 1, {block_bytes})").alias("block"),
    ).withColumn("sort_key", F.xxhash64("block"))


def integer_names(keys: DataFrame, *columns: str) -> DataFrame:
    """Sort distinct keys over the cluster; the place of a key is its integer name."""
    ordered = keys.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return stage(ordered.withColumn("name", F.monotonically_increasing_id()), "block-names")


def name_blocks(blocks: DataFrame) -> DataFrame:
    """Replace the bytes of each block by its integer name."""
    per_key = stage(blocks.select("sort_key", "block").distinct()
                    .groupBy("sort_key").agg(F.count("*").alias("n")), "block-keys")
    shared = stage(per_key.where("n > 1").select("sort_key"), "block-shared-keys")
    keyed = blocks.withColumn("tie", F.lit(0))
    if not shared.isEmpty():  # different blocks under one key: content decides their order
        within = Window.partitionBy("sort_key").orderBy("block")
        ties = stage(
            blocks.join(shared, "sort_key", "left_semi").select("sort_key", "block").distinct()
            .select("sort_key", "block", (F.row_number().over(within) - 1).alias("tie")),
            "block-ties")
        keyed = blocks.join(ties, ["sort_key", "block"], "left").withColumn(
            "tie", F.coalesce("tie", F.lit(0)))
    names = integer_names(
        per_key.select("sort_key", F.explode(F.expr("sequence(0, int(n) - 1)")).alias("tie")),
        "sort_key", "tie")
    return keyed.drop("block").join(names, ["sort_key", "tie"]).select(
        "doc_id", "digest", "n_blocks", "pos", "name")


def pair_up(named: DataFrame, copies: str) -> DataFrame:
    """Put adjacent names of a document side by side; -1 where the last one is alone."""
    even = F.col("pos") % 2 == 0
    return stage(
        named.groupBy("doc_id", "digest", "n_blocks", F.expr("pos div 2").alias("pos")).agg(
            F.max(F.when(even, F.col("name"))).alias("left_name"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right_name"),
            F.expr(copies).cast("long").alias("copies")),
        "block-pairs")


def document_names(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, digest, n_blocks, name, copies: one row per distinct (doc_id, digest)."""
    blocks = cut_blocks(docs, doc_id, text, block_bytes)
    pairs = pair_up(name_blocks(blocks), "sum(int(pos % 2 = 0))")
    last = ["doc_id", "digest", "n_blocks", F.col("left_name").alias("name"), "copies"]
    done = pairs.where("n_blocks = 1").select(*last)
    longest = pairs.agg(F.max("n_blocks")).first()[0] or 1
    open_pairs, width = pairs.where("n_blocks > 1"), 2
    while width < 2 * longest:
        keys = ["left_name", "right_name"]
        names = integer_names(open_pairs.select(*keys).distinct(), *keys)
        named = open_pairs.join(names, keys)
        done = done.unionByName(named.where(f"n_blocks <= {width}").select(
            "doc_id", "digest", "n_blocks", "name", "copies"))
        width *= 2
        if width < 2 * longest:
            open_pairs = pair_up(named.where(f"n_blocks > {width // 2}"), "max(copies)")
    return stage(done, "document-names")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (after lower-casing A-Z) the row with the largest id is kept; among
    repeated rows of that id exactly one.
    """
    identities = document_names(docs, doc_id, text, block_bytes)
    groups = stage(identities.groupBy("n_blocks", "name").agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")), "text-groups")
    joined = identities.join(groups, ["n_blocks", "name"])
    return joined.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keep, digest, many = "__keep_id", "__digest", "__many"
    fate = stage(exact_duplicates(docs, doc_id, text).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("kept"), F.count("*").alias("n")).where("kept").select(
        F.col("doc_id").alias(keep), F.col("text_sha256").alias(digest),
        (F.col("n") > 1).alias(many)), "text-kept")
    rows = docs.withColumn("__sha", F.sha2(fold_case(F.col(text)), 256))
    kept = rows.join(fate, rows["__sha"].eqNullSafe(fate[digest])
                     & rows[doc_id].eqNullSafe(fate[keep]))
    once = kept.where(~F.col(many)).select(*docs.columns)
    if fate.where(many).isEmpty():
        return once
    repeated = kept.where(many).dropDuplicates([keep, digest]).select(*docs.columns)
    return once.unionByName(repeated)
