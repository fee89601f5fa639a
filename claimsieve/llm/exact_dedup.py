"""Exact duplicates by deterministic block naming.

A text without its blanks is cut into blocks of a fixed size. Different blocks are sorted and get
integer names; then names of adjacent blocks are paired, different pairs get names in turn, until
every text has one name left. Texts have the same name and number of blocks exactly if they are
equal: names come from comparing contents, not from trusting a hash.

Content moves once, as one copy of each block per map task. A 64-bit hash only finds the rows
again: where a hash should stand for two different blocks, the content itself is the join key.

Defined results: NULL counts as the empty text, which is a text like any other; of equal texts the
longest original stays, then the smallest id (NULL last), then one of the equal rows; an empty
table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.common import KEY, SPACE, columns_of, keep_rows, stored, text_key

#: Code points in a block.
BLOCK = 4096


def _names(values: DataFrame, keys: tuple[str, ...], label: str) -> DataFrame:
    """An integer for every different key: tasks take hash partitions and number their rows in sorted order."""
    different = values.select(*keys).distinct().sortWithinPartitions(*keys)
    return stored(different.withColumn("name", F.monotonically_increasing_id()), label)


def block_hash(block: str) -> Column:
    return F.xxhash64(block)


def _with_blocks(docs: DataFrame, block: int) -> DataFrame:
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    solid = texts.withColumn("solid", F.regexp_replace("text", SPACE, ""))
    cut = F.regexp_extract_all("solid", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    cut = solid.withColumn("blocks", F.when(F.length("solid") <= block, F.array("solid")).otherwise(cut))
    return cut.select(
        "row",
        "doc_id",
        text_key(),
        F.length("text").alias("n_chars"),
        F.sha2("solid", 256).alias("text_sha256"),
        "blocks",
        F.size("blocks").alias("n_blocks"),
    )


def _first_names(blocks: DataFrame) -> DataFrame:
    """(row, n_blocks, pos, name) of every block."""
    different = blocks.select("h", "block").distinct()
    hashes = different.groupBy("h").agg(F.count(F.lit(1)).alias("contents")).sortWithinPartitions("h")
    hashes = stored(hashes.withColumn("name", F.monotonically_increasing_id()), "block-names")
    place = ["row", "n_blocks", "pos"]
    shared = hashes.where("contents > 1").select("h", "contents")
    if shared.isEmpty():
        return blocks.select(*place, "h").join(hashes, "h").select(*place, "name")
    # Different blocks under one hash: each takes its rank among them as a further digit of the name.
    width = shared.agg(F.max("contents")).first()[0]
    ranks = different.join(shared, "h", "left_semi").groupBy("h").agg(F.array_sort(F.collect_list("block")).alias("b"))
    ranks = ranks.select("h", F.posexplode("b").alias("rank", "block"))
    ranked = blocks.join(ranks, ["h", "block"], "left").select(*place, "h", F.coalesce("rank", F.lit(0)).alias("rank"))
    return ranked.join(hashes, "h").select(*place, (F.col("name") * width + F.col("rank")).alias("name"))


def identities(texts: DataFrame) -> DataFrame:
    """(row, n_blocks, name) of every text; ``texts`` has a row number, the blocks and their number."""
    flat = texts.select("row", "n_blocks", F.posexplode("blocks").alias("pos", "block"))
    level = stored(_first_names(flat.withColumn("h", block_hash("block"))), "names")
    longest = texts.agg(F.max("n_blocks")).first()[0] or 0
    named = level.where("n_blocks = 1").select("row", "n_blocks", "name")
    level = level.where("n_blocks > 1")
    reach = 1
    while reach < longest:
        reach *= 2
        even = F.col("pos") % 2 == 0
        pairs = level.groupBy("row", "n_blocks", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
        )
        pairs = stored(pairs, "pairs")
        level = pairs.join(_names(pairs, ("a", "b"), "pair-names"), ["a", "b"]).select("row", "n_blocks", "pos", "name")
        named = named.unionAll(level.where(F.col("n_blocks") <= reach).select("row", "n_blocks", "name"))
        level = level.where(F.col("n_blocks") > reach)
    return named


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_chars and the text's hash for every row of ``docs``."""
    texts = stored(_with_blocks(columns_of(docs, doc_id=id_col, text=text_col), block), "texts")
    named = texts.select("row", "doc_id", "n_chars", "text_sha256", KEY).join(identities(texts), "row")
    named = stored(named, "identities")
    first = F.struct(
        -F.col("n_chars"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row")
    )
    groups = named.groupBy("n_blocks", "name").agg(F.count(F.lit(1)).alias("group_size"), F.min(first).alias("first"))
    groups = groups.select("n_blocks", "name", "group_size", "first.doc_id", "first.row").toDF(
        "n_blocks", "name", "group_size", "keep_id", "keep_row"
    )
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256", "n_chars", KEY
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, exact_groups(docs, id_col, text_col, block), id_col, text_col)
