"""Sum-of-squares online packing of token sequences into windows.

A document is cut only where it must be: into whole windows and one rest. Rests are placed one after another. An array
counts the open windows of each fill level; a rest goes to the level, or to a new window, for which the sum of the
squared counts afterwards is least. This keeps few windows at every level, so that partners for all lengths remain.

Pieces, not tokens, are shuffled. They are dealt by a hash into blocks of about ``BLOCK`` pieces that are packed
independently, each in document order, so the result does not depend on the layout of the input. A null or empty text
is its end token; repeated rows are packed as often as they occur; an empty table gives no piece.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleet.llm.bpe import encoder, ids_crc32
from fleet.llm.common import map_rows
from fleet.operators.keys import join_on
from fleet.scratch import Scratch

BLOCK = 20_000
#: Equal pieces that fill more than this part of a block are spread.
SHARE_OF_COPIES = 8

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
_PIECES_SQL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(df: DataFrame, tokenizer: str, end_id: int, window: int) -> DataFrame:
    """Pieces of each text's ids with the end id: whole windows, then the rest."""

    def cut(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {f.name: [] for f in _PIECES}
        encode = encoder(tokenizer)
        for doc_id, encoded in zip(rows["doc_id"], encode.encode(rows["text"])):
            ids = np.append(encode.ids(encoded).astype("<u4"), np.uint32(end_id))
            for start in range(0, len(ids), window):
                piece = ids[start : start + window]
                for name, value in zip(out, (doc_id, start, len(piece), ids_crc32(piece), len(ids))):
                    out[name].append(value)
        return out

    return map_rows(df.select("doc_id", "text"), cut, _PIECES, _PIECES_SQL)


def sum_of_squares(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of every length, in the given order; equal costs go to the fullest window."""
    counts = np.zeros(window + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(window)]
    numbers, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        level = 0
        if size < window:
            after, before = counts[size : window + 1], counts[: window + 1 - size]
            # Change of the sum when a window of this level moves up, halved: the full level counts for nothing.
            cost = np.where(before > 0, 2 * (after - before) + 2, np.iinfo(np.int64).max)
            if before[-1] > 0:
                cost[-1] = 1 - 2 * before[-1]
            cost[0] = 2 * counts[size] + 1
            level = len(cost) - 1 - int(cost[::-1].argmin())
        if level:
            number = open_at[level].pop()
            counts[level] -= 1
        else:
            number, made = made, made + 1
        numbers[i], offsets[i] = number, level
        if level + size < window:
            counts[level + size] += 1
            open_at[level + size].append(number)
    return numbers, offsets


def pack(pieces: DataFrame, window: int, block: int = BLOCK) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``window`` tokens.

    ``sequence_id`` is the block's number times 2^32 plus the window's number in the block.
    """
    stored = Scratch(pieces.sparkSession).store(pieces, "pieces")
    blocks = max(1, -(-stored.count() // block))
    by = ["doc_id", "start", "length", "ids_crc32"]
    salt = F.lit(0).cast("long")
    copies = stored.groupBy(*by).agg(F.count(F.lit(1)).alias("_copies")).where(F.col("_copies") > max(1, block // SHARE_OF_COPIES))
    dealt = stored
    if blocks > 1 and not copies.isEmpty():  # pieces that are often repeated go round the blocks by their place in the table
        dealt = join_on(stored, copies, by, "left")
        salt = F.when(F.col("_copies").isNull(), salt).otherwise(F.monotonically_increasing_id())
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64(*by, salt), F.lit(blocks)).cast("long")).drop("_copies")
    columns = stored.columns

    def fill(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        numbers, pdf["offset"] = sum_of_squares(pdf["length"].to_numpy(), window)
        pdf["sequence_id"] = (int(key[0]) << 32) + numbers
        return pdf[[*columns, "sequence_id", "offset"]]

    kind = ", ".join(f"`{n}` {t}" for n, t in stored.dtypes)
    return dealt.groupBy("_block").applyInPandas(fill, f"{kind}, sequence_id long, offset long")
