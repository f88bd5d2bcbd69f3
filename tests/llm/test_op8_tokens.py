import struct
import zlib

import numpy as np
import pytest

from lendspark.llm.common import filesystem, ship, table
from lendspark.llm.op8_tokens import Encoder, TokenReader, TokenWriter, encode_documents, op8_tokens
from tests_llm_helpers import SF, crowd

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
WORDS, BYTES = public.path("word_bpe_49k.json"), public.path("byte_bpe_50k.json")

ODD = [
    "", " ", "Plain words, and 42 numbers!", "don't we'll THEY'RE 's x's", "<|startoftext|> a<|endoftext|>b", "é É é ñ ß ẞ İ ı",
    "日本語 текст 한국어", "a b c\x85d", "x²½ ª№ _under_score__", "\x0b\x0cv\tt", "AÀÖØöøÿ×÷", "🙂🙂 ok", "ﬁ ǅ Σς", "a" * 5000,
]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_equals_the_library(path):
    full = tokenizers.Tokenizer.from_file(path)
    texts = ODD + [" ".join(ODD), "\n".join(ODD)]
    got = Encoder.of(path).encode([t.encode() for t in texts])
    want = [np.array(full.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert got == want
    assert Encoder.of(path).encode([t.encode() for t in texts]) == want  # from the cache


def test_punctuation_is_moved_off_only_at_borders():
    """What the library cuts there anyway is one chunk, so that fewer are encoded."""
    marks = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    full = tokenizers.Tokenizer.from_file(WORDS)
    heads = ["a", "Z", "7", "é", "É", "ß", "×", "÷", "x\u0301", "İ", "ı", "я", "日", "²", "ª", "'", "a'", "-"]
    texts = [f"{h}{m}{t}" for h in heads for m in [*marks, "$$$", "'s", "),.", "<|", "|>"] for t in (" b", "\n", "", "s it", "\u0338 c", "\x85")]
    texts += [f"{h}<|endoftext|>. $$$ {h}$$$ " for h in heads] + ["", " ", "\n\n", "$"]
    want = [np.array(full.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert Encoder(WORDS).encode([t.encode() for t in texts]) == want
    assert [Encoder(WORDS).encode([t.encode()]) for t in texts[::97]] == [[w] for w in want[::97]]
    assert Encoder(WORDS).encode([]) == []
    chunks, codes, per_text = Encoder._words([t.encode() for t in ("Ah... ah!!! 4$", "é&&& <| ah.", "", "é&&& ah!!!")])
    assert sorted(chunks.to_pylist()) == sorted([b"ah", b"...", b"!!!", b"4", b"$", "é&&&".encode(), b"<|", b"ah.", "é".encode(), b"&&&"])
    assert per_text.tolist() == [6, 3, 0, 4] and len(codes) == 13


def brute(rows):
    full = tokenizers.Tokenizer.from_file(WORDS)
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = full.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark):
    rows = [(r[0], r[1]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op8_tokens(spark, SF).collect()), key=lambda r: r[1])
    assert got == brute(rows)


def test_nulls_repeats_long_and_empty(spark):
    rows = [(3, "b"), (1, None), (3, "a"), (None, "z"), (2, "word " * 40_000), (3, "a"), (0, "")]
    df = crowd(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(map(tuple, ship(lambda s: encode_documents(df))(spark).collect()), key=lambda r: r[1])
    assert got == brute(rows)
    assert ship(lambda s: encode_documents(df.limit(0)))(spark).count() == 0


def test_file_reads_only_asked_frames_and_checks_them(tmpdir_path):
    import zstandard

    docs = [(i if i % 3 else None, struct.pack(f"<{n}I", *range(n))) for i, n in enumerate([5, 0, 70_000, 3, 150_000, 1])]
    path = tmpdir_path + "/x.zst"
    with open(path, "wb") as out:
        writer = TokenWriter(out)
        for d in docs:
            writer.add(*d)
        writer.close()
    fs, p = filesystem(path)
    reader = TokenReader(fs, p)
    assert [(i if v else None) for i, v in zip(reader.ids.tolist(), reader.valid)] == [i for i, _ in docs]
    assert dict(reader.documents()) == dict(enumerate(b for _, b in docs))
    assert len(reader.frames) >= 3
    read = []
    reader.frame = lambda k, f=reader.frame: (read.append(k), f(k))[1]
    assert dict(reader.documents([2])) == {2: docs[2][1]} and read == [int(reader.of_frame[2])]
    # Any zstandard reader can read the frames in order; it skips the tables.
    with open(path, "rb") as f:
        plain = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert plain == b"".join(b for _, b in docs)
    raw = bytearray(open(path, "rb").read())
    raw[int(reader.starts[1]) + 40] ^= 255
    open(path, "wb").write(raw)
    with pytest.raises(Exception):
        list(TokenReader(fs, p).documents())


def test_other_operators_tasks_free_the_encoder(spark):
    """A worker's encoder serves the operator's own tasks and is gone in another's."""
    from lendspark.llm import common

    common.KEPT.clear()
    common.KEPT["op8_tokens"] = {"path": "an encoder"}
    assert list(common.tidy(iter, keeps="op8_tokens")(range(3))) == [0, 1, 2]
    assert common.KEPT == {"op8_tokens": {"path": "an encoder"}}
    assert list(common.tidy(iter)(range(2))) == [0, 1]
    assert common.KEPT == {}
