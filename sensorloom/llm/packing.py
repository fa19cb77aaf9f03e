"""Best-fit packing of tokenised documents under several capacities at once.

A bin (sequence) has three residual capacities: tokens, documents, and attention cost (the sum of
squared piece lengths). Pieces are placed in falling order of length; among the open bins that can
take a piece under every constraint, the one with the largest weighted dot product of demand and
residual, or the smallest weighted norm of what would remain, is chosen. Bins with equal residuals are
interchangeable, so the open bins are kept as distinct residual vectors with the bins that have them.

Only pieces that do not fill a bin alone are packed; they are dealt into groups of about
``GROUP_PIECES`` pieces by the hash of their id and each group is packed on its own, which costs about
one part-filled bin a group. The number of groups follows the number of pieces.

Defined results: a null or empty text is the end token alone; rows with equal ids and texts are pieces
of their own (they may trade places); an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from sensorloom.llm.common import written

END_TOKEN = 2
#: Pieces packed together. More pack a little tighter and take a little longer.
GROUP_PIECES = 4096
#: Distinct chunks of text whose token ids a worker remembers.
CACHE_CHUNKS = 300_000
# Fixed value: a text with this string is left to the tokenizer as a whole.
SPECIAL = "<|endoftext|>"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. ``weights`` scale tokens, documents and attention cost in the choice."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
    choose: str = "norm"


# ---------------------------------------------------------------- tokens


_ODD_SPACE = re.compile(r" \s|\s |^\s|\s$")
_TOKENIZERS: dict[str, "ChunkTokenizer"] = {}


class ChunkTokenizer:
    """Token ids of whole texts, remembered by chunk.

    The pattern that splits a text before the merges always begins a new part at a space that stands
    between two characters which are not white space. So a text without other runs of white space
    around its spaces can be cut there, and equal chunks have equal ids wherever they stand. All other
    texts are encoded as a whole.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        vocabulary = json.loads(self.whole.to_str())["model"]["vocab"]
        letters = _byte_letters()
        ranks = {}
        for token, number in vocabulary.items():
            if token != SPECIAL:
                ranks[bytes(letters[c] for c in token)] = number
        self.encoding = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.known: dict[str, array] = {}

    def ids(self, text: str) -> array:
        if SPECIAL in text:
            return array("I", self.whole.encode(text, add_special_tokens=False).ids)
        if _ODD_SPACE.search(text):
            return array("I", self.encoding.encode_ordinary(text))
        out, known, encode = array("I"), self.known, self.encoding.encode_ordinary
        if len(known) > CACHE_CHUNKS:
            known.clear()
        chunks = text.split(" ")
        chunks[1:] = [" " + c for c in chunks[1:]]
        for chunk in chunks:
            found = known.get(chunk)
            if found is None:
                found = array("I", encode(chunk))
                if len(chunk) < 64:
                    known[chunk] = found
            out.extend(found)
        return out


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in plain]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


def tokenizer(path: str) -> ChunkTokenizer:
    """One a worker process, as loading takes a while."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


def tokenised_pieces(docs: DataFrame, vocabulary: str, tokens: int) -> DataFrame:
    """Every document cut into pieces of at most ``tokens``; only the first may be shorter."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokenizer(vocabulary)
        names = [c.split()[0] for c in PIECES.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encoder.ids(text or "")
                ids.append(END_TOKEN)
                data = memoryview(ids.tobytes())
                number = None if pd.isna(doc_id) else int(doc_id)
                start, piece = 0, 0
                end = len(ids) % tokens or tokens
                while start < len(ids):
                    rows.append((number, piece, start, end - start, zlib.crc32(data[4 * start : 4 * end])))
                    start, end, piece = end, end + tokens, piece + 1
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    exact = docs.select(F.col("doc_id").cast("decimal(20,0)"), F.coalesce("text", F.lit("")).alias("text"))
    return exact.mapInPandas(cut, PIECES)


# ---------------------------------------------------------------- bins


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; ``lengths`` fall."""
    weights = np.array(capacity.weights)
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], np.int64)
    scale = weights / full
    kinds: dict[tuple[int, int, int], int] = {}
    free = np.zeros((64, 3), np.int64)  # distinct residuals
    members: list[list[int]] = []  # bins that have them
    spare: list[int] = []
    used = 0
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)

    def put(residual: np.ndarray, number: int) -> None:
        nonlocal used, free
        key = tuple(residual.tolist())
        slot = kinds.get(key)
        if slot is None:
            if spare:
                slot = spare.pop()
            else:
                slot, used = used, used + 1
                members.append([])
                if used > len(free):
                    free = np.vstack([free, np.zeros_like(free)])
            kinds[key] = slot
            free[slot] = residual
        members[slot].append(number)

    n_bins = 0
    for i, length in enumerate(lengths.tolist()):
        demand = np.array([length, 1, length * length], np.int64)
        rest = free[:used] - demand
        fits = (rest >= 0).all(axis=1)
        if fits.any():
            if capacity.choose == "dot":
                score = -((free[:used] * scale) @ (demand * scale))
            else:
                score = np.square(rest * scale).sum(axis=1)
            slot = int(np.where(fits, score, np.inf).argmin())
            number = members[slot].pop()
            residual = free[slot].copy()
            if not members[slot]:
                del kinds[tuple(residual.tolist())]
                free[slot] = -1
                spare.append(slot)
        else:
            residual, number = full.copy(), n_bins
            n_bins += 1
        bins[i], offsets[i] = number, capacity.tokens - residual[0]
        residual -= demand
        if residual[0] > 0 and residual[1] > 0:
            put(residual, number)
    return bins, offsets


def packed(docs: DataFrame, vocabulary: str, capacity: Capacity = Capacity(), group_pieces: int = GROUP_PIECES) -> DataFrame:
    """All pieces with the sequence and the offset that each one has there."""
    pieces = written(tokenised_pieces(docs, vocabulary, capacity.tokens), "pieces")
    alone = F.col("length") >= capacity.tokens
    # Ids: whole pieces are numbered within their task, packed bins within their group; one is even.
    whole = pieces.where(alone).withColumns(
        {"sequence_id": 2 * F.monotonically_increasing_id() + 1, "offset": F.lit(0).cast("long")}
    )
    loose = pieces.where(~alone)
    groups = max(1, -(-loose.count() // group_pieces))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "start"], ascending=[False, True, True, True])
        bins, offsets = best_fit(group["length"].to_numpy(), capacity)
        first = int(group["bucket"].iloc[0]) << 32
        group["sequence_id"], group["offset"] = 2 * (first + bins), offsets
        return group[[c.split()[0] for c in PACKED.split(", ")]].astype({"doc_id": "Int64"})

    # Rows that are alike in every column are told apart by their row in the written table.
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups))
    bins = loose.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(pack, PACKED)
    return whole.select(*bins.columns).unionByName(bins)
