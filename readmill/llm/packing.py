"""Best-fit packing of token sequences under several capacities.

A sequence has three capacities: tokens, number of documents, and attention cost (the sum of
squared lengths). Pieces are placed in falling order of length. Of the sequences in which a
piece fits under every capacity, the best is the one with the least weighted norm of what
would be left (``rule="norm"``) or the greatest weighted dot product of what is left with
what the piece needs (``rule="dot"``), both in shares of the capacities.

Pieces are dealt out by a hash to groups of about ``GROUP_PIECES``, and each group is packed
by itself, so that a task holds a bounded number of them. A group ends with about one
sequence that could not be filled, well under a thousandth of its sequences.

A NULL or empty text is one piece with the closing id only. Repeated rows and rows without
``doc_id`` are packed like others. A document longer than a sequence is cut; all its pieces
but the last are full. An empty table gives an empty result. Only ``doc_id`` and ``text``
are read, so that other columns may have any name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmill.llm.batches import map_arrow, slices
from readmill.llm.columns import passed
from readmill.llm.pretokens import WordIds
from readmill.session import materialise, ship_library

TOKENIZER = "word_bpe_49k.json"
TOKENS = 2048
#: Id that closes a document.
CLOSE = b"\0\0\0\0"
GROUP_PIECES = 16_384
#: Weights of tokens, documents and attention cost.
WEIGHTS = (1.0, 0.0, 0.0)

_encoders: dict[str, WordIds] = {}


def cut_documents(docs: DataFrame, path: str | None = None, tokens: int = TOKENS) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece of each document."""
    path = path or public_tokenizers.path(TOKENIZER)

    def task(batches):
        encode = _encoders.setdefault(path, WordIds(path))
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows, piece, start, length, crc = [], [], [], [], []
                for row, ids in enumerate(encode(texts)):
                    ids += CLOSE
                    for k, at in enumerate(range(0, len(ids), 4 * tokens)):
                        own = ids[at : at + 4 * tokens]
                        rows.append(row)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()).take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return map_arrow(
        docs.select("doc_id", "text"), task, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(
    lengths: np.ndarray,
    tokens: int,
    documents: int | None = None,
    attention: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, by vector best-fit in falling order of length."""
    full = np.array([tokens, documents or tokens, attention or tokens * tokens], dtype=np.int64)
    scale = np.asarray(weights, dtype=float) / (full.astype(float) ** 2)
    n = len(lengths)
    place, offset = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    left = np.empty((3, max(n, 1)), dtype=np.int64)
    number = np.empty(max(n, 1), dtype=np.int64)
    opened = used = 0  # sequences so far; columns of `left` that are in use
    order = np.lexsort((np.arange(n), -lengths))
    least = int(lengths.min(initial=tokens))
    for i in order:
        need = np.array([lengths[i], 1, lengths[i] ** 2], dtype=np.int64)
        if (need > full).any():
            raise ValueError(f"a piece of {lengths[i]} tokens fits no sequence")
        column = -1
        if used:
            fits = np.flatnonzero((left[0, :used] >= need[0]) & (left[1, :used] >= 1) & (left[2, :used] >= need[2]))
            if len(fits):
                rest = left[:, fits]
                if rule == "norm":
                    score = scale @ ((rest - need[:, None]).astype(float) ** 2)
                else:
                    score = -(scale * need) @ rest
                column = int(fits[np.argmin(score)])
        if column < 0:
            column = used
            left[:, column] = full
            number[column] = opened
            opened, used = opened + 1, used + 1
        place[i], offset[i] = number[column], tokens - left[0, column]
        left[:, column] -= need
        if left[0, column] < least or left[1, column] < 1:  # nothing fits any more: the last column takes its place
            used -= 1
            left[:, column], number[column] = left[:, used], number[used]
    return place, offset


def pack(
    pieces: DataFrame,
    tokens: int = TOKENS,
    documents: int | None = None,
    attention: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """``pieces`` (of which ``doc_id``, ``piece`` and ``length`` are read) with ``sequence_id`` and ``offset``.

    ``pieces`` is counted and then read again: pass a written table.
    """
    pieces = passed(pieces, ("sequence_id", "offset"))
    groups = max(1, -(-pieces.count() // group_pieces))

    def task(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "length"], kind="stable").reset_index(drop=True)
        place, offset = best_fit(rows["length"].to_numpy(), tokens, documents, attention, weights, rule)
        return rows.assign(sequence_id=place + (int(key[0]) << 32), offset=offset).drop(columns="_group")

    ship_library(pieces.sparkSession)
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy("_group").applyInPandas(task, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, tokens: int = TOKENS) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack(materialise(cut_documents(docs, path, tokens), "pieces"), tokens)
