"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts of up to ``chunk`` characters are encoded where they are read.  A longer
text is cut into chunks that reach ``overlap`` characters into their
successors.  All chunks are pre-tokenised in parallel, each from its own first
character; the pattern looks only ahead, so as soon as two neighbours share a
pre-token boundary they agree on all later ones.  The text is cut at the first
shared boundary after a character that is no white space (there the pieces
encode like the whole).  Where an overlap has none, as inside one very long
pre-token, the neighbours become one piece.  Pieces are encoded in parallel
and hashed in order, as a stream.  Decoding concatenates the tokens' bytes.

Defined cases: a null text is empty (no ids); an empty table gives no rows;
repeated rows and null ``doc_id``s give one row each; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierwise.llm.common import Scratch, map_batches, pieces, spill, tidy

CHUNK = 1 << 16
OVERLAP = 1 << 10
#: matches that end this close to a chunk's end may go on beyond it
UNSURE = 3
BATCH = 4 << 20

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

_CODERS: dict[tuple[str, str], Coder] = {}


class Coder:
    """Ids of texts and bytes of ids, by a file of ranks and a pattern."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.encode = self.encoding.encode_ordinary

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(path, pattern)
    return _CODERS[path, pattern]


def boundaries(text: str, pattern, whole: bool) -> list[int]:
    """Where pre-tokens end, as far as the text decides it, and 0."""
    ends = [0, *(m.end() for m in pattern.finditer(text))]
    return ends if whole else [e for e in ends if e <= len(text) - UNSURE]


def cuts(text: str, ends: list[int], lo: int, hi: int) -> list[int]:
    """Boundaries in ``lo..hi`` that follow a character other than white
    space, relative to ``lo``."""
    return [e - lo for e in ends if lo < e <= hi and not text[e - 1].isspace()]


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``row, no, doc_id, ids``: the ids of each document's pieces, which
    ``no`` orders; ``row`` tells repeated ``doc_id``s apart."""
    if not 0 < overlap < chunk:
        raise ValueError("chunks must be longer than their overlap")
    with Scratch(docs.sparkSession, "byte-bpe") as scratch:
        short, long = _parts(docs, path, pattern, chunk, overlap, scratch)
        return spill(short.unionByName(long), "token-pieces")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def _encode_pieces(texts: DataFrame, path: str, pattern: str) -> DataFrame:
    def run(batches):
        c = coder(path, pattern)
        for whole in batches:
            for b in pieces(whole, BATCH, "text"):
                ids = pa.array([c.encode(t) for t in b.column("text").to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("no"), b.column("doc_id"), ids], ["row", "no", "doc_id", "ids"])
        tidy()

    return map_batches(texts.select("row", "no", "doc_id", "text"), run, "row long, no long, doc_id long, ids array<int>")


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    def run(batches):
        for whole in batches:
            for b in pieces(whole, BATCH, "text"):
                for row, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                    starts = range(0, len(text), chunk)
                    for at in range(0, len(starts), 64):
                        some = starts[at : at + 64]
                        yield pa.RecordBatch.from_pydict({
                            "row": pa.array([row] * len(some), pa.int64()), "doc_id": pa.array([doc_id] * len(some), pa.int64()),
                            "no": pa.array([s // chunk for s in some], pa.int64()),
                            "last": pa.array([s + chunk >= len(text) for s in some], pa.bool_()),
                            "size": pa.array([min(chunk, len(text) - s) for s in some], pa.int64()),
                            "body": pa.array([text[s : s + chunk + overlap] for s in some], pa.string()),
                        })
        tidy()

    return map_batches(texts, run, "row long, doc_id long, no long, last boolean, size long, body string").repartition("row", "no")


def _zones(chunks: DataFrame, pattern: str, overlap: int) -> DataFrame:
    """Boundaries of each chunk where its predecessor and its successor
    overlap it."""

    def run(batches):
        compiled = regex.compile(pattern)
        kind = pa.list_(pa.int64())
        for whole in batches:
            for b in pieces(whole, BATCH, "body"):
                heads, tails = [], []
                for text, size, last in zip(*(b.column(c).to_pylist() for c in ("body", "size", "last")), strict=True):
                    # the body's end is the text's end only where nothing was left out
                    ends = boundaries(text, compiled, last)
                    heads.append(cuts(text, ends, 0, overlap))
                    tails.append(cuts(text, ends, size, size + overlap))
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("no"), b.column("last"), pa.array(heads, kind), pa.array(tails, kind)], ["row", "no", "last", "heads", "tails"])
        tidy()

    return map_batches(chunks.select("row", "no", "size", "last", "body"), run, "row long, no long, last boolean, heads array<long>, tails array<long>")


def _stitch(chunks: DataFrame, pattern: str, overlap: int, scratch: Scratch) -> DataFrame:
    """``row, no, doc_id, text``: pieces that encode like the whole.

    A chunk's boundaries are known to be the text's only if it agrees with
    its predecessor, so chunks that don't are joined to theirs and looked at
    again; a round leaves fewer chunks, and usually none to join."""
    by_text = Window.partitionBy("row").orderBy("no")
    while True:
        zones = scratch.spill(_zones(chunks, pattern, overlap))
        near = zones.withColumn("before", F.lag("tails").over(by_text))
        spans = near.select("row", "no", "last", (F.col("no") == 0).alias("first"), F.array_min(F.array_intersect("heads", "before")).alias("cut"))
        alone = F.col("first") | F.col("cut").isNotNull()
        spans = scratch.spill(spans.select(
            "row", "no", "last", alone.alias("alone"), F.when(F.col("first"), 0).otherwise(F.col("cut")).alias("lo"),
            F.lead("cut").over(by_text).alias("next"), F.max(F.when(alone, F.col("no"))).over(by_text).alias("head"),
        ))
        if spans.where(~F.col("alone")).isEmpty():
            upto = F.when(F.col("last"), F.length("body")).otherwise(F.col("size") + F.col("next"))
            part = F.substring("body", (F.col("lo") + 1).cast("int"), (upto - F.col("lo")).cast("int"))
            return chunks.drop("last").join(spans, ["row", "no"]).select("row", "no", "doc_id", part.alias("text"))
        placed = chunks.join(spans.select("row", "no", "head"), ["row", "no"])
        groups = placed.groupBy("row", "head").agg(
            F.first("doc_id").alias("doc_id"), F.max("last").alias("last"), F.sum("size").alias("size"),
            F.sort_array(F.collect_list(F.struct("no", F.substring("body", F.lit(1), F.col("size").cast("int")).alias("own")))).alias("parts"),
            F.max_by(F.substring("body", (F.col("size") + 1).cast("int"), F.lit(overlap)), "no").alias("beyond"),
        )
        body = F.concat(F.array_join("parts.own", ""), "beyond")
        chunks = scratch.spill(groups.select("row", "doc_id", F.col("head").alias("no"), "last", "size", body.alias("body")))


def _parts(docs: DataFrame, path: str, pattern: str, chunk: int, overlap: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Encoded pieces of the texts that are one chunk, and of the others."""
    texts = _texts(docs)
    is_long = F.length("text") > chunk
    short = _encode_pieces(texts.where(~is_long).withColumn("no", F.lit(0).cast("long")), path, pattern)
    chunks = scratch.spill(_chunks(texts.where(is_long), chunk, overlap))
    return short, _encode_pieces(_stitch(chunks, pattern, overlap, scratch), path, pattern)


def _digest(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Streams pieces that lie in order; only the hashes of the document at
    hand are kept."""

    def run(batches):
        c = coder(path, pattern)
        at, out = None, []
        for b in batches:
            for row, doc_id, ids in zip(*(b.column(n).to_pylist() for n in ("row", "doc_id", "ids")), strict=True):
                if at is None or at[0] != row:
                    if at is not None:
                        out.append(at[1:])
                    at = [row, doc_id, 0, hashlib.sha256(), hashlib.sha256()]
                if ids:
                    at[3].update((("," if at[2] else "") + ",".join(map(str, ids))).encode())
                    at[4].update(c.decode(ids))
                    at[2] += len(ids)
            yield _batch(out)
            out = []
        if at is not None:
            yield _batch([at[1:]])
        tidy()

    def _batch(rows):
        names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
        values = [[r[0] for r in rows], [r[1] for r in rows], [r[2].hexdigest() for r in rows], [r[3].hexdigest() for r in rows]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names)

    return map_batches(encoded.select("row", "doc_id", "ids"), run, DIGESTS)


def digests(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per document: number of ids, hash of the ids, hash of the decoded bytes."""
    with Scratch(docs.sparkSession, "byte-bpe") as scratch:
        short, long = _parts(docs, path, pattern, chunk, overlap, scratch)
        in_order = long.repartition("row").sortWithinPartitions("row", "no")
        return spill(_digest(short, path, pattern).union(_digest(in_order, path, pattern)), "bpe-digests")
