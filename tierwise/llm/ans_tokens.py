"""Token ids in a compact binary form: static range asymmetric numeral system.

Documents are dealt out in ascending ``doc_id`` order, tokenized once, and
gathered into independent blocks of whole documents.  One table of symbol
frequencies, counted over every token, is shared by all blocks.  Inside a
block the tokens are interleaved over many coder lanes, so one step of the
coder is a vector operation; every ``CHECKPOINT`` steps the lane states and
the word position are stored, so a block can be decoded from several places
at once, and a CRC-32 closes each frame.

A file set is a folder of three Parquet tables: ``blocks`` (one frame a row),
``parts`` (tokens before each part) and ``model`` (the frequency table).
Parquet rows carry the frames so that any file system Spark can write works
and a lost executor leaves no half-written file.

Defined cases: a null text is empty, so its document is the end id alone;
null ``doc_id``s come first; rows with one ``doc_id`` are ordered by text;
an empty table gives an empty file set; columns besides ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.llm.common import Scratch, map_batches, pieces, shared_path, tidy

END_ID = 2
BLOCK_TOKENS = 1 << 18
MAX_LANES = 1024
CHECKPOINT = 128
LOW = np.uint64(1 << 31)
W32 = np.uint64(32)
MAGIC = b"TIDS"
VERSION = 1
_HEAD = struct.Struct("<4sHHQIIIQ")  # magic, version, precision, tokens, lanes, checkpoints, documents, words

TOKEN_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"

#: white space other than the space and the line feed
_RARE = [chr(i) for i in range(0x3001) if chr(i).isspace() and chr(i) not in " \n"] + ["\u180e", "\u200b", "\ufeff"]
#: a space that a visible character follows always starts a new piece
_SPLIT = re.compile("(?= [^\\s\u180e\u200b\ufeff])")
#: a word that closes with one mark, which is a piece of its own
_MARKED = "^\\n?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+[.,]$"
#: bytes of text encoded at once, and of the longest word that is kept
_TEXT_BYTES = 8 << 20
_WORD_BYTES = 64
_ENCODERS: dict[str, TextEncoder] = {}


class TextEncoder:
    """Encodes texts with the ``tokenizers`` library.

    Byte-level tokenizers cut a text into pieces (words with the space before
    them, runs of marks, white space) that encode independently, so words are
    gathered over many texts as Arrow arrays and each distinct one is encoded
    once, with the space or the line feed before it.  About ``keep`` of them
    are kept; the ones met in the fewest calls are dropped first.  Texts with
    other white space are cut only before spaces that a visible character
    follows.  Other tokenizers encode whole texts.
    """

    def __init__(self, path: str, keep: int = 750_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.keep = keep
        pre = repr(self.tok.pre_tokenizer)
        self.by_piece = pre.startswith("ByteLevel(") and "add_prefix_space=False" in pre and "use_regex=True" in pre and self.tok.normalizer is None
        self.first: dict[str, bytes] = {}  # at the start of a text
        #: after a space (without it), or a line feed (with it); without a
        #: mark that closes the word; their ids, and the calls that met them
        self.words, self.codes = pa.array([], pa.string()), pa.array([], pa.binary())
        self.uses = np.zeros(0, np.int64)
        if self.by_piece:
            #: tokens that begin with a space or are a line feed
            self.opens = np.zeros(size, bool)
            for token, i in self.tok.get_vocab(with_added_tokens=False).items():
                self.opens[i] = token.startswith("\u0120")
            self.opens[self._ids(["\n"])[0]] = True
            self.closing = {m: self._ids([m])[0].tobytes() for m in ".,"}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for lo in range(0, len(texts), 500):
            out += [np.array(e.ids, dtype=self.dtype) for e in self.tok.encode_batch_fast(texts[lo : lo + 500], add_special_tokens=False)]
        return out

    def _learn(self, words: pa.StringArray) -> pa.BinaryArray:
        """Encodes new words, many to a text."""
        pieces = [w if w[:1] == "\n" else " " + w for w in words.to_pylist()]
        plain, odd = [], []
        for i, p in enumerate(pieces):
            (plain if len(p) > 1 and p[1:].isprintable() and " " not in p[1:] else odd).append(i)
        groups = [plain[i : i + 200] for i in range(0, len(plain), 200)]
        order, found, sizes = [], [], [[0]]
        for group, ids in zip(groups, self._ids(["".join([pieces[i] for i in g]) for g in groups]), strict=True):
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) != len(group):
                odd += group
                continue
            order += group
            found.append(ids)
            sizes.append(np.diff(cuts, append=len(ids)))
        alone = self._ids([pieces[i] for i in odd])
        sizes.append([len(ids) for ids in alone])
        raw = b"".join(x.tobytes() for x in found + alone)
        ends = np.cumsum(np.concatenate(sizes), dtype=np.int64) * self.dtype.itemsize
        coded = pa.BinaryArray.from_buffers(pa.binary(), len(pieces), [None, pa.array(ends, pa.int32()).buffers()[1], pa.py_buffer(raw)])
        return coded.take(pa.array(np.argsort(order + odd)))

    def _codes_of(self, words: pa.StringArray) -> pa.BinaryArray:
        """The ids of distinct words; a word that closes with one mark is its
        core and the mark."""
        marked = pc.match_substring_regex(words, _MARKED)
        cores = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words).dictionary_encode()
        own = cores.dictionary
        at = pc.index_in(own, value_set=self.words)
        new = own.filter(at.is_null())
        learnt = self._learn(new)
        place = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = place < 0
        self.uses[place[~fresh]] += 1
        place[fresh] = len(self.words) + np.arange(len(new))
        codes = pa.concat_arrays([self.codes, learnt]).take(pa.array(place)).take(cores.indices)
        self._remember(new, learnt)
        mark = pc.if_else(pc.ends_with(words, "."), pa.scalar(self.closing["."]), pa.scalar(self.closing[","]))
        return pc.binary_join_element_wise(codes, pc.if_else(marked, mark, pa.scalar(b"")), pa.scalar(b""))

    def _remember(self, words: pa.StringArray, codes: pa.BinaryArray) -> None:
        short = pc.less_equal(pc.binary_length(words), _WORD_BYTES)
        words, codes = words.filter(short), codes.filter(short)
        self.words, self.codes = pa.concat_arrays([self.words, words]), pa.concat_arrays([self.codes, codes])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int64)])
        if len(self.words) > self.keep:
            best = np.sort(np.argsort(self.uses, kind="stable")[len(self.uses) - self.keep // 2 :])
            self.words, self.codes, self.uses = self.words.take(pa.array(best)), self.codes.take(pa.array(best)), self.uses[best] // 2

    def _join(self, words: pa.StringArray, starts: np.ndarray) -> list[bytes]:
        """The ids of texts given as their words one after the other;
        ``starts`` has the place of each text's first word, and the end."""
        leads = np.zeros(len(words), bool)
        leads[starts[:-1]] = True
        heads = words.filter(pa.array(leads)).to_pylist()
        if len(self.first) > self.keep:
            self.first.clear()
        new = list(set(heads).difference(self.first))
        self.first.update(zip(new, (x.tobytes() for x in self._ids(new)), strict=True))
        rest = words.filter(pa.array(~leads)).dictionary_encode()
        coded = self._codes_of(rest.dictionary).take(rest.indices)
        _, ends, raw = coded.buffers()
        at = np.frombuffer(ends, np.int32, len(coded) + 1)[starts - np.arange(len(starts))].tolist() if len(coded) else [0] * len(starts)
        raw = memoryview(raw or b"")
        return [self.first[h] + raw[lo:hi] for h, lo, hi in zip(heads, at, at[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The token ids of each text, as little-endian integers."""
        if not self.by_piece:
            return [x.tobytes() for x in self._ids(texts)]
        out: list[bytes] = [b""] * len(texts)
        odd = [i for i, t in enumerate(texts) if _odd(t)]
        if odd:
            cut = [[head, *(r[1:] for r in rest)] for head, *rest in (_SPLIT.split(texts[i]) for i in odd)]
            starts = np.cumsum([0, *map(len, cut)])
            for i, raw in zip(odd, self._join(pa.array([w for c in cut for w in c], pa.string()), starts), strict=True):
                out[i] = raw
        if len(odd) < len(texts):
            even = sorted(set(range(len(texts))).difference(odd))
            cut = pc.split_pattern(pc.replace_substring(pa.array([texts[i] for i in even], pa.string()), "\n", " \n"), " ")
            for i, raw in zip(even, self._join(cut.values, cut.offsets.to_numpy()), strict=True):
                out[i] = raw
        return out


def _odd(t: str) -> bool:
    """Whether white space is anything but one space or line feed between
    visible characters."""
    return (
        "  " in t or "\n\n" in t or " \n" in t or "\n " in t or t[:1] in ("", " ", "\n") or t[-1] in " \n" or any(c in t for c in _RARE)
    )


def encoder(path: str) -> TextEncoder:
    """The worker's encoder for a vocabulary file, made once per process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


# --- the coder ---------------------------------------------------------------


class FrequencyTable:
    """Symbol frequencies scaled to a power of two; every symbol that occurs
    keeps a share."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray, bits: int):
        self.symbols, self.freq_of, self.bits = symbols.astype(np.int64), freq.astype(np.uint64), bits
        size = int(self.symbols.max(initial=-1)) + 1
        self.freq = np.zeros(size, np.uint64)
        self.cum = np.zeros(size, np.uint64)
        self.freq[self.symbols] = self.freq_of
        self.cum[self.symbols] = np.concatenate(([0], np.cumsum(self.freq_of)[:-1])) if len(freq) else self.freq_of
        self.slots = np.repeat(self.symbols, self.freq_of.astype(np.int64)).astype(np.uint32)

    @classmethod
    def scaled(cls, symbols, counts, bits: int = 20) -> FrequencyTable:
        order = np.argsort(symbols)
        symbols, counts = np.asarray(symbols)[order], np.asarray(counts, dtype=np.int64)[order]
        if not len(symbols):
            return cls(symbols.astype(np.int64), counts, bits)
        bits = max(bits, int(len(symbols)).bit_length() + 2)
        total, room = int(counts.sum()), 1 << bits
        freq = np.maximum(1, (counts.astype(np.float64) * room / total).astype(np.int64))
        over = int(freq.sum()) - room
        if over < 0:  # settle the rounding on the largest share
            freq[np.argmax(freq)] -= over
        elif over > 0:  # or on all shares above one, in proportion
            spare = freq - 1
            cut = -(-spare * over // int(spare.sum()))
            cut[np.flatnonzero(cut)[: int(cut.sum()) - over]] -= 1
            freq -= cut
        return cls(symbols, freq, bits)

    def pack(self) -> bytes:
        body = struct.pack("<HI", self.bits, len(self.symbols)) + self.symbols.astype("<u4").tobytes() + self.freq_of.astype("<u4").tobytes()
        return body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def unpack(cls, raw: bytes) -> FrequencyTable:
        if zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("frequency table: checksum differs")
        bits, n = struct.unpack_from("<HI", raw)
        return cls(np.frombuffer(raw, "<u4", n, 6), np.frombuffer(raw, "<u4", n, 6 + 4 * n), bits)


def encode_block(ids: np.ndarray, doc_ids: list, counts: list, table: FrequencyTable) -> bytes:
    """One frame: header, documents, checkpoints, words, checksum."""
    n = len(ids)
    lanes = int(min(MAX_LANES, max(1, n // 256)))
    steps = -(-n // lanes)
    bits = np.uint64(table.bits)
    limit = np.uint64(63 - table.bits)
    x = np.full(lanes, LOW, np.uint64)
    words, marks, written = [], [], 0
    f_all, c_all = table.freq[ids], table.cum[ids]
    for t in range(steps - 1, -1, -1):
        f, c = f_all[t * lanes : (t + 1) * lanes], c_all[t * lanes : (t + 1) * lanes]
        cur = x[: len(f)]
        big = cur >= (f << limit)
        out = cur[big].astype(np.uint32)
        words.append(out)
        written += len(out)
        cur = np.where(big, cur >> W32, cur)
        q = cur // f
        x[: len(f)] = (q << bits) + (cur - q * f) + c
        if t % CHECKPOINT == 0:
            marks.append((t, written, x.copy()))
    marks.reverse()
    body = [_HEAD.pack(MAGIC, VERSION, table.bits, n, lanes, len(marks), len(doc_ids), written)]
    body.append(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    body.append(bytes(d is None for d in doc_ids))
    body.append(np.array(counts, "<u8").tobytes())
    for t, w, states in marks:
        body += [struct.pack("<QQ", t, written - w), states.astype("<u8").tobytes()]
    body += [w.astype("<u4").tobytes() for w in reversed(words)]
    raw = b"".join(body)
    return raw + struct.pack("<I", zlib.crc32(raw))


def decode_block(frame: bytes, table: FrequencyTable, only: int | None = None):
    """Document ids, token counts and token ids of a frame; ``only`` decodes
    just the tokens between one checkpoint and the next."""
    if zlib.crc32(memoryview(frame)[:-4]) != struct.unpack("<I", frame[-4:])[0]:
        raise ValueError("block: checksum differs")
    magic, version, bits, n, lanes, n_marks, n_docs, n_words = _HEAD.unpack_from(frame)
    if magic != MAGIC or version != VERSION or bits != table.bits:
        raise ValueError("block: not of this format or model")
    at = _HEAD.size
    own = np.frombuffer(frame, "<i8", n_docs, at).tolist()
    missing = frame[at + 8 * n_docs : at + 9 * n_docs]
    counts = np.frombuffer(frame, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
    at += 17 * n_docs
    marks = []
    for _ in range(n_marks):
        t, w = struct.unpack_from("<QQ", frame, at)
        marks.append((t, w, np.frombuffer(frame, "<u8", lanes, at + 16)))
        at += 16 + 8 * lanes
    words = np.frombuffer(frame, "<u4", n_words, at)
    steps = -(-n // lanes)
    parts = range(n_marks) if only is None else [only]
    out = []
    shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    freq, cum, slots = table.freq, table.cum, table.slots
    for i in parts:
        t0, p, states = marks[i]
        t1 = marks[i + 1][0] if i + 1 < n_marks else steps
        x = states.copy()
        for t in range(t0, t1):
            m = min(lanes, n - t * lanes)
            cur = x[:m]
            slot = cur & mask
            s = slots[slot]
            out.append(s)
            cur = freq[s] * (cur >> shift) + slot - cum[s]
            need = np.flatnonzero(cur < LOW)
            if len(need):
                cur[need] = (cur[need] << W32) | words[p : p + len(need)]
                p += len(need)
            x[:m] = cur
    ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
    return [None if gone else d for d, gone in zip(own, missing, strict=True)], counts, ids


# --- Spark jobs --------------------------------------------------------------

_RAW = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("seq", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("counts", T.ArrayType(T.LongType())),
    T.StructField("ids", T.BinaryType()),
])


def _raw_blocks(path: str, end_id: int, block_tokens: int):
    """Tokenizes a sorted partition into blocks of whole documents."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        seq = start = held = 0
        docs, counts, ids = [], [], []

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([start], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([docs], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([b"".join(ids)], pa.binary())],
                _RAW.fieldNames(),
            )

        for batch in batches:
            for piece in pieces(batch, _TEXT_BYTES, "text"):
                coded = enc.encode([t or "" for t in piece.column("text").to_pylist()])
                for doc, raw in zip(piece.column("doc_id").to_pylist(), coded, strict=True):
                    n = len(raw) // width + 1
                    docs.append(doc)
                    counts.append(n)
                    ids += (raw, end)
                    held += n
                    if held >= block_tokens:
                        yield block()
                        seq, start, held = seq + 1, start + held, 0
                        docs, counts, ids = [], [], []
        if docs:
            yield block()
        tidy()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> str:
    """Encodes every document and writes the file set under ``path``."""
    spark = docs.sparkSession
    wide = encoder(tokenizer).dtype
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    with Scratch(spark, "token-ids") as scratch:
        raw = scratch.spill(map_batches(dealt, _raw_blocks(tokenizer, end_id, block_tokens), _RAW))
        table = _write_blocks(raw, path, wide)
    # one row a part: as many as the job had partitions
    sizes = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    before, base = 0, []
    for r in sorted(sizes, key=lambda r: r["part"]):
        base.append((r["part"], before))
        before += r["n"]
    spark.createDataFrame(base, "part int, base long").coalesce(1).write.parquet(f"{path}/parts")
    spark.createDataFrame([(bytearray(table),)], "table binary").write.parquet(f"{path}/model")
    return path


def _write_blocks(raw: DataFrame, path: str, wide: np.dtype) -> bytes:
    """Counts the tokens, codes the blocks by the shared table, returns it."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for ids in b.column("ids"):
                own = np.bincount(np.frombuffer(ids.as_buffer(), wide))
                if len(own) > len(total):
                    own[: len(total)] += total
                    total = own
                else:
                    total[: len(own)] += own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    # at most one row for each id of the vocabulary
    seen = map_batches(raw.select("ids"), count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    table = FrequencyTable.scaled(np.array([r["id"] for r in seen], np.int64), np.array([r["n"] for r in seen], np.int64)).pack()

    def code(batches):
        model = FrequencyTable.unpack(table)
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                frame = encode_block(
                    np.frombuffer(row.column("ids")[0].as_buffer(), wide), row.column("doc_ids")[0].as_py(), row.column("counts")[0].as_py(), model
                )
                yield pa.RecordBatch.from_arrays(
                    [row.column("part"), row.column("seq"), row.column("start"), row.column("n_tokens"), pa.array([frame], pa.binary())],
                    ["part", "seq", "start", "n_tokens", "frame"],
                )

    frames = map_batches(raw, code, "part int, seq long, start long, n_tokens long, frame binary")
    frames.write.option("compression", "none").parquet(f"{path}/blocks")
    return table


def _load(spark: SparkSession, path: str):
    table = bytes(spark.read.parquet(f"{path}/model").first()["table"])
    return table, {r["part"]: r["base"] for r in spark.read.parquet(f"{path}/parts").collect()}


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Decodes a file set: ``doc_id, start, n_tokens, ids_crc32`` per
    document, read from the frames."""
    return _decoded(spark, path, False)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Decodes a file set to ``doc_id, start, ids``."""
    return _decoded(spark, path, True)


def _decoded(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    table, base = _load(spark, path)

    def run(batches):
        model = FrequencyTable.unpack(table)
        for b in batches:
            for part, start, frame in zip(b.column("part").to_pylist(), b.column("start").to_pylist(), b.column("frame"), strict=True):
                docs, counts, ids = decode_block(frame.as_py(), model)
                ends = np.cumsum(counts)
                firsts = ends - counts
                cols = [pa.array(docs, pa.int64()), pa.array(firsts + base[part] + start, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(ids, pa.int64())))
                else:
                    raw, step = memoryview(ids.astype("<u4").tobytes()), zip((4 * firsts).tolist(), (4 * ends).tolist(), strict=True)
                    cols += [pa.array(counts, pa.int64()), pa.array([zlib.crc32(raw[lo:hi]) for lo, hi in step], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "ids"] if with_ids else ["doc_id", "start", "n_tokens", "ids_crc32"])

    blocks = spark.read.parquet(f"{path}/blocks").select("part", "start", "frame")
    return map_batches(blocks, run, "doc_id long, start long, ids array<long>" if with_ids else TOKEN_SCHEMA)


def tokens_of(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the file set to the shared folder and reads it back."""
    return read_tokens(docs.sparkSession, write_tokens(docs, shared_path(docs.sparkSession, "tokens"), tokenizer))
