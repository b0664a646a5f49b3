"""Exact dedup by two-pass Bloom filtering, in DataFrame operations only.

Pass one hashes every text into the cells of a counting filter (a row of the shuffle is a cell and
a partial count, never a text) and keeps, as bitmaps, the cells that at least two rows hit. Pass two
tests each row's cells: a row with a cell that nobody else hit is certainly unique and passes
straight through; only the possibly repeated rows shuffle, by digest, to be settled exactly. False
positives of the filter cost a little shuffle and never change the result.

The filter has 16 bits a row, or as few as 4 where MAX_FILTER_BITS, which are broadcast, give no more. Beyond that no machine need
hold it: each bitmap meets, by a shuffle on its page number, the rows of digests and ids alone (under 100 bytes a
row, no text). `exact_groups` reads the texts once whatever the size; `deduplicate` then shuffles each row's text
once, by digest, since no bounded filter can tell the unique rows apart any more.

Defined results: a null text counts as empty; a null id sorts below all others; of equal texts the
row with the largest id stays; rows that share both text and id count as copies and, in `deduplicate`,
collapse to one; an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import fresh, quoted, written

PAGE_BITS = 32_768  # of one bitmap as Spark's bitmap functions lay it out
MAX_FILTER_BITS = 1 << 28  # of a broadcast filter: 32 MB
BITS_PER_ROW = 16
LEAST_BITS = 4  # a sixth of the unique rows pass for possible copies
HOT_SHARE = 1_000  # a group with over 1/1000 of the candidate rows is hot; there are at most 1000


def _cells(text: Column, bits: int) -> list[Column]:
    """Two independent cells of a text."""
    return [F.pmod(F.xxhash64(text, F.lit(seed)), F.lit(bits)) for seed in (1, 2)]


def filter_bits(rows: int) -> int:
    bits = PAGE_BITS
    while bits < rows * BITS_PER_ROW:
        bits *= 2
    return bits


def repeated_cells(df: DataFrame, text: Column, bits: int) -> DataFrame:
    """Bitmaps (page, bitmap) of the filter's cells that two or more rows hit."""
    cell = df.select(F.explode(F.array(*_cells(text, bits))).alias("cell"))
    # bitmap_bit_position and bitmap_bucket_number count from bit 1
    return (cell.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
            .select((F.col("cell") + 1).alias("bit"))
            .groupBy(F.bitmap_bucket_number("bit").alias("page"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap")))


def _bit_set(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce((F.pmod(F.floor(byte / F.pow(F.lit(2), position % 8)).cast("int"), F.lit(2)) == 1), F.lit(False))


def with_candidate_flag(df: DataFrame, text: Column, flag: str, bits: int, broadcast: bool = True) -> DataFrame:
    """df with a boolean column: may another row have the same text? False is certain."""
    pages = written(repeated_cells(df, text, bits))  # once, not in every branch of the plans that use the flag
    out, names = df, []
    for i, cell in enumerate(_cells(text, bits)):
        c, page, bitmap = fresh(out, f"cell{i}", f"page{i}", f"bitmap{i}")
        side = pages.select(F.col("page").alias(page), F.col("bitmap").alias(bitmap))
        out = (out.withColumn(c, cell)
               .join(F.broadcast(side) if broadcast else side,
                     F.bitmap_bucket_number(F.col(c) + 1) == F.col(page), "left"))
        names.append((c, page, bitmap))
    test = F.lit(True)
    for c, _, bitmap in names:
        test = test & _bit_set(F.col(bitmap), F.bitmap_bit_position(F.col(c) + 1))
    return out.withColumn(flag, test).drop(*[x for t in names for x in t])


def _groups(candidates: DataFrame, id_name: str, digest: str) -> tuple[DataFrame, DataFrame]:
    """(hot, other) groups of candidate rows: digest, keep, size. Hot ones are at most HOT_SHARE."""
    groups = candidates.groupBy(digest).agg(F.max(id_name).alias("_lk_keep"), F.count(F.lit(1)).alias("_lk_size"))
    groups = written(groups)
    total = groups.agg(F.sum("_lk_size")).first()[0] or 0
    limit = max(1_000, total // HOT_SHARE)
    return groups.where(F.col("_lk_size") > limit), groups.where((F.col("_lk_size") <= limit) & (F.col("_lk_size") > 1))


def _plan(rows: int, most: int) -> tuple[int, bool]:
    """Bits of the filter, and whether it is broadcast: with LEAST_BITS a row it still tells most unique rows apart."""
    bits = filter_bits(rows)
    return (min(bits, max(most, PAGE_BITS)), True) if rows * LEAST_BITS <= most else (bits, False)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per row of df: doc_id, keep_id, group_size, kept, text_sha256. The texts are read once."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    lean = written(df.select(F.col(quoted(id_col)).alias("doc_id"), F.sha2(text, 256).alias("text_sha256")))
    bits, small = _plan(lean.count(), most_bits)
    flagged = written(with_candidate_flag(lean, F.col("text_sha256"), "_lk_maybe", bits, small).select("doc_id", "text_sha256", "_lk_maybe"))
    maybe = flagged.where("_lk_maybe")
    hot, other = _groups(maybe, "doc_id", "text_sha256")
    held = maybe.join(F.broadcast(hot), "text_sha256", "left")
    in_hot = held.where("_lk_size is not null")
    rest = held.where("_lk_size is null").drop("_lk_keep", "_lk_size").join(other, "text_sha256", "left")
    alone = flagged.where("not _lk_maybe").withColumns({"_lk_keep": F.col("doc_id"), "_lk_size": F.lit(1).cast("long")})
    every = in_hot.unionByName(rest).unionByName(alone)
    size = F.coalesce("_lk_size", F.lit(1).cast("long"))
    keep = F.when(size == 1, F.col("doc_id")).otherwise(F.col("_lk_keep"))
    return every.select("doc_id", keep.alias("keep_id"), size.alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """df without the rows whose text a row with a larger id has; columns as they were."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    flag, digest, keep = fresh(df, "maybe", "digest", "keep")
    columns = [quoted(c) for c in df.columns]
    bits, small = _plan(df.count(), most_bits)
    if small:
        flagged = with_candidate_flag(df, text, flag, bits)
        unique, maybe = flagged.where(~F.col(flag)).select(*columns), flagged.where(flag).withColumn(digest, F.sha2(text, 256))
    else:
        unique, maybe = df.limit(0), df.withColumn(digest, F.sha2(text, 256))
    # The aggregate moves (digest, id), combined before the shuffle. The join's keys are digest and id
    # together, so even one group with a third of all rows is dealt over all tasks.
    groups = maybe.groupBy(F.col(digest).alias(digest + "_g")).agg(F.max(quoted(id_col)).alias(keep))
    kept = (maybe.join(groups, (F.col(digest) == F.col(digest + "_g")) & F.col(quoted(id_col)).eqNullSafe(F.col(keep)))
            .dropDuplicates([digest]).select(*columns))
    return unique.unionByName(kept)
