"""Token-id files: independent zstandard frames with a trailing seek table.

Layout of one file:

* frames, each a complete zstandard frame of whole documents' ids as
  little-endian unsigned 32-bit integers (about ``FRAME_IDS`` ids; a longer
  document has a frame of its own), with the frame's own checksum on;
* a skippable frame with the document table: ids, token counts, frames;
* a skippable frame with the seek table of the public seekable format:
  compressed size, size and checksum (low half of XXH64) of every frame.

A reader fetches the tail, then only the frames of the documents asked for,
and checks every frame it reads.

Documents are dealt by ranges of their id and sorted inside each range, so
the files in order of their part hold all documents in ascending order. Files
are written into the shared folder under new names; a small Parquet table of
the finished files is written last, so a repeated or lost task leaves at most
an unlisted file.

Defined cases: a null text is empty and has only the end id; null ids come
first; equal ids follow each other, ordered by text; an empty table gives no
file and no row; extra columns are ignored.
"""

from __future__ import annotations

import gc
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import KEPT, filesystem, scratch_dir, ship, table, tidy

END_ID = 2
FRAME_IDS = 65_536
SLICE_BYTES = 1_000_000
# Ids kept per worker: bytes of one generation, with what an entry costs besides
# its text; longer chunks are not kept.
CACHE_BYTES, ENTRY_BYTES, LONG_CHUNK = 40_000_000, 160, 100
# One piece that normalisation leaves as it is: lower-case letters (ASCII and
# Latin-1), ASCII punctuation, a digit.
PIECE = re.compile(rb"(?:[a-z]+|\xc3[\x9f-\xb6\xb8-\xbf])+|(?!.*<\|)[!-/:-@\[-`{-~]+|[0-9]")
_BYTES = np.arange(256)
SPACE = (_BYTES == 32) | (_BYTES >= 9) & (_BYTES <= 13)
ALNUM = np.isin(_BYTES, np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))
MARK = (_BYTES > 32) & (_BYTES < 127) & ~ALNUM
LATIN = (_BYTES >= 0x80) & (_BYTES < 0xC0) & (_BYTES != 0x97) & (_BYTES != 0xB7)  # after 0xC3
LEVEL = 3

DOC_MAGIC = 0x184D2A5D
SEEK_MAGIC = 0x184D2A5E
SEEK_FOOTER = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

# The split rule of the word vocabularies this cache knows (a fixed value).
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Ids of whole texts, as bytes.

    For a vocabulary that lower-cases, drops white space and splits by
    ``WORD_SPLIT``, no token reaches over white space or a border of that
    split, so the ids of each white-space-free chunk and of its pieces are kept
    and looked up. Other vocabularies are encoded text by text.
    """

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One encoder a worker process: its cache serves all its tasks, until
        another operator's task comes."""
        made = KEPT.setdefault("op8_tokens", {})
        if path not in made:
            made[path] = cls(path)
        return made[path]

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        rules = json.dumps([spec.get("normalizer"), spec.get("pre_tokenizer")])
        self.by_word = (
            spec["model"].get("end_of_word_suffix") == "</w>"
            and json.dumps(WORD_SPLIT)[1:-1] in rules
            and all(k in rules for k in ('"Lowercase"', '"NFC"', '"\\\\s+"'))
        )
        if not self.by_word:
            return
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocab = self.full.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.split = regex.compile(WORD_SPLIT)
        # Composed Latin letters and ASCII: normalisation changes only their case.
        self.plain = regex.compile(r"(?!.*<\|)[\x21-\x7eÀ-įı-ɏ]+")
        self.chunks = Cache(CACHE_BYTES)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            found = self.full.encode_batch([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(x.ids, "<u4").tobytes() for x in found]
        chunks, codes, per_text = self._words(texts)
        _, offsets, data = chunks.buffers()
        cuts = np.frombuffer(offsets, np.int32)[chunks.offset : chunks.offset + len(chunks) + 1].tolist()
        raw = data.to_pybytes() if data else b""
        distinct = [raw[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        # No reference cycles are made here, and the collector's rounds over
        # the cache are a tenth of the time.
        gc.disable()
        try:
            long = self._learn(self.chunks.missing(set(distinct)))
        finally:
            gc.enable()
        known = self.chunks.young
        known.update(long)
        found = list(map(known.__getitem__, distinct))
        for chunk in long:
            del known[chunk]
        self.chunks.age()
        # Ids of the distinct chunks, laid out by the text's codes.
        ids, size = np.frombuffer(b"".join(found), "<u4"), np.array(list(map(len, found)), np.int64) // 4
        first, size = (np.cumsum(size) - size).take(codes), size.take(codes)
        ends = np.cumsum(size)
        first -= ends - size
        out = ids.take(np.repeat(first, size) + np.arange(ends[-1] if len(ends) else 0)).tobytes()
        cuts = (4 * np.append(0, ends).take(np.append(0, np.cumsum(per_text)))).tolist()
        return [out[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]

    @staticmethod
    def _words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(distinct chunks, number of each chunk in order, chunks of each text).

        ASCII case never matters, but special tokens are looked for as they
        stand. ASCII punctuation between a letter or digit and white space is
        a piece of its own; it is moved off, so that fewer chunks differ.
        """
        as_is = np.array([b"<|" in t for t in texts], bool)
        data = np.frombuffer(b"\n" + b"".join([(t if k else t.lower()) + b"\n" for t, k in zip(texts, as_is, strict=True)]), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        mark, space = MARK.take(data), SPACE.take(data)
        first = np.flatnonzero(mark[1:] & ~mark[:-1]) + 1
        last = np.flatnonzero(mark[:-1] & ~mark[1:])
        before = data.take(first - 1)
        letter = ALNUM.take(before)
        latin = np.flatnonzero(LATIN.take(before))
        letter[latin] = data.take(first[latin] - 2) == 0xC3
        off = np.flatnonzero(letter & space.take(last + 1))
        if as_is.any():
            off = off[~as_is.take(np.searchsorted(ends, first[off]))]
        # A chunk starts after white space and where punctuation was moved off.
        start = ~space
        start[1:] &= space[:-1]
        start[first[off]] = True
        at = np.flatnonzero(start)
        body = data[~space]
        place = np.append((np.cumsum(~space, dtype=np.int32) - 1).take(at), len(body)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(place), pa.py_buffer(body)])
        coded = chunks.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(at, ends, "right"), prepend=0)

    def _learn(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new chunks into the cache; those of long chunks are returned."""
        single: list[str] = []
        split: list[tuple[bytes, list[str]]] = []
        odd: list[bytes] = []
        for c in chunks:
            s = c.decode()
            if PIECE.fullmatch(c):
                single.append(s)
            elif self.plain.fullmatch(s):
                low = s.lower()
                pieces = self.split.findall(low)
                if len(pieces) == 1 and low == s:
                    single.append(s)
                else:
                    split.append((c, pieces))
            else:
                odd.append(c)
        pieces = {p.encode() for _, ps in split for p in ps}.difference(s.encode() for s in single)
        single += [p.decode() for p in self.chunks.missing(pieces)]
        # Pieces are encoded together, one white space apart.
        long: dict[bytes, bytes] = {}
        for k in range(0, len(single), 1000):
            part = single[k : k + 1000]
            ids = np.array(self.bare.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                packed, ends = ids.tobytes(), (4 * cuts).tolist()
                found = [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            else:
                found = [np.array(self.full.encode(p, add_special_tokens=False).ids, "<u4").tobytes() for p in part]
            for p, x in zip(part, found, strict=True):
                self._keep(p.encode(), x, long)
        young = self.chunks.young
        for c, ps in split:
            self._keep(c, b"".join([long[p] if p in long else young[p] for p in (p.encode() for p in ps)]), long)
        encoded = self.full.encode_batch([c.decode() for c in odd], add_special_tokens=False)
        for c, x in zip(odd, encoded, strict=True):
            self._keep(c, np.array(x.ids, "<u4").tobytes(), long)
        return long

    def _keep(self, chunk: bytes, ids: bytes, long: dict) -> None:
        if len(chunk) <= LONG_CHUNK:
            self.chunks.put(chunk, ids)
        else:
            long[chunk] = ids


class Cache:
    """Entries of two generations. One that is used moves to the young one;
    when that is full, it becomes the old one and the old one goes."""

    def __init__(self, most: int):
        self.most, self.size = most, 0
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: set) -> list:
        """Keys in neither generation; the others are young after the call."""
        out = []
        for k in keys:
            if k not in self.young:
                if (v := self.old.get(k)) is None:
                    out.append(k)
                else:
                    self.put(k, v)
        return out

    def put(self, key, value: bytes) -> None:
        self.young[key] = value
        self.size += len(key) + len(value) + ENTRY_BYTES

    def age(self) -> None:
        if self.size > self.most:
            self.young, self.old, self.size = {}, self.young, 0


class TokenWriter:
    """Writes one file to an open binary stream."""

    def __init__(self, out):
        import zstandard

        self.out, self.zstd = out, zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.of_frame: list[int] = []
        self.held: list[bytes] = []
        self.held_bytes = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.held and self.held_bytes + len(ids) > 4 * FRAME_IDS:
            self._flush()
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.of_frame.append(len(self.frames))
        self.held.append(ids)
        self.held_bytes += len(ids)

    def _flush(self) -> None:
        import xxhash

        data = b"".join(self.held)
        packed = self.zstd.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.held, self.held_bytes = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        table = b"".join(
            [
                struct.pack("<Q", len(self.ids)),
                np.array([i or 0 for i in self.ids], "<i8").tobytes(),
                np.array([i is not None for i in self.ids], "u1").tobytes(),
                np.array(self.counts, "<i8").tobytes(),
                np.array(self.of_frame, "<i4").tobytes(),
            ]
        )
        packed = self.zstd.compress(table)
        self.out.write(struct.pack("<II", DOC_MAGIC, len(packed)) + packed)
        seek = b"".join(struct.pack("<III", *f) for f in self.frames)
        seek += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_FOOTER)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(seek)) + seek)


class TokenReader:
    """Random access to the documents of one file."""

    def __init__(self, fs, path: str):
        import zstandard

        self.file, self.zstd = fs.open_input_file(path), zstandard.ZstdDecompressor()
        size = self.file.size()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_FOOTER or not flag & CHECKSUM_FLAG:
            raise ValueError(f"{path}: no seek table")
        at = size - 9 - 12 * n - 8
        self.frames = np.frombuffer(self._at(at + 8, 12 * n), "<u4").reshape(n, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.frames[:, 0], dtype=np.int64)])
        magic, length = struct.unpack("<II", self._at(int(self.starts[-1]), 8))
        if magic != DOC_MAGIC or int(self.starts[-1]) + 8 + length != at:
            raise ValueError(f"{path}: no document table")
        t = self.zstd.decompress(self._at(int(self.starts[-1]) + 8, length))
        (m,) = struct.unpack_from("<Q", t)
        self.ids = np.frombuffer(t, "<i8", m, 8)
        self.valid = np.frombuffer(t, "u1", m, 8 + 8 * m).astype(bool)
        self.counts = np.frombuffer(t, "<i8", m, 8 + 9 * m)
        self.of_frame = np.frombuffer(t, "<i4", m, 8 + 17 * m)

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def frame(self, k: int) -> bytes:
        import xxhash

        data = self.zstd.decompress(self._at(int(self.starts[k]), int(self.frames[k, 0])))
        if len(data) != self.frames[k, 1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.frames[k, 2]:
            raise ValueError(f"frame {k}: wrong checksum")
        return data

    def documents(self, positions: Iterable[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """(position, ids) of the documents at ascending ``positions`` (all, if None)."""
        last, data, first = -1, b"", 0
        before = np.concatenate([[0], np.cumsum(self.counts)])
        for p in range(len(self.ids)) if positions is None else positions:
            if (k := int(self.of_frame[p])) != last:
                last, data, first = k, self.frame(k), int(np.searchsorted(self.of_frame, k))
            a = int(before[p] - before[first]) * 4
            yield p, data[a : a + 4 * int(self.counts[p])]


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the token files of ``docs`` into ``folder``; returns the table of
    finished files (part, file, n_docs, n_ids), parts in document order."""
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, out = Encoder.of(tokenizer), TaskContext.get().partitionId(), None
        fs, path = filesystem(folder)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            size = texts.nbytes // max(1, len(ids)) + 1
            step = max(1, SLICE_BYTES // size)
            for k in range(0, len(ids), step):
                if out is None:
                    fs.create_dir(path, recursive=True)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.zst"
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    writer = TokenWriter(out)
                for i, x in zip(ids[k : k + step], encoder.encode(texts[k : k + step].to_pylist()), strict=True):
                    writer.add(i, x + end)
        if out is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "file": name, "n_docs": len(writer.ids), "n_ids": sum(writer.counts)}],
                schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    parts = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    done = f"{folder}/files"
    parts.mapInArrow(tidy(write, keeps="op8_tokens"), "part int, file string, n_docs long, n_ids long").write.parquet(done)
    return docs.sparkSession.read.schema("part int, file string, n_docs long, n_ids long").parquet(done)


def read_tokens(files: DataFrame, folder: str) -> DataFrame:
    """Every document of the files: (doc_id, start, n_tokens, ids_crc32)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                reader = TokenReader(fs, f"{path}/{row['file']}")
                starts = row["first"] + np.concatenate([[0], np.cumsum(reader.counts)[:-1]])
                crc = [zlib.crc32(ids) for _, ids in reader.documents()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.ids, pa.int64(), mask=~reader.valid),
                        pa.array(starts, pa.int64()),
                        pa.array(reader.counts, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # One row per file: the running sum is over files, not documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    dealt = placed.repartitionByRange(max(1, files.count()), "part")
    return dealt.mapInArrow(tidy(read, keeps="op8_tokens"), "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write token files into the shared folder and read them back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = scratch_dir(docs.sparkSession, "token-files")
    return read_tokens(write_tokens(docs, folder, tokenizer), folder)


@ship
def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and crc32 of every document's ids, read from the files."""
    return encode_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op8_tokens": op8_tokens}
SQL: dict[str, str] = {}
