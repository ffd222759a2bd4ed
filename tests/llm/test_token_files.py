import random
import struct
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.conftest import by_id
from voxlake.llm import chunks as C
from voxlake.llm import queries
from voxlake.llm import token_files as T
from voxlake.settings import shared_folder

tokenizers = pytest.importorskip("tokenizers")
SOURCE = queries.tokenizer_file("byte_bpe_50k.json")
ODD = ["", " ", "\n", "a  b", "  \n  lead", "trail  \n ", "x  y 　 z", " \n x", "é" * 40,
       "日本語 テスト", "🙂🙂 🙂", "it's we'll I'D", "<|endoftext|> a<|endoftext|>", "x\x1c y\x1f\n z\r\n\r\nq",
       "12,345.67 ==== \t\t tab", "\x00\x01", "a  b c \u0085 d"]


def whole(text):
    own = tokenizers.Tokenizer.from_str(SOURCE.decode())
    return own.encode(text, add_special_tokens=False).ids


def test_chunks_are_encoded_as_in_their_text():
    pick, alphabet = random.Random(3), " \n\t\r 　aéb7.'s,日🙂\x1c"
    texts = ODD + ["".join(pick.choice(alphabet) for _ in range(pick.randrange(40))) for _ in range(400)]
    import pyarrow as pa
    ids, starts = T._encoded(pa.array(texts), SOURCE)
    own = tokenizers.Tokenizer.from_str(SOURCE.decode())
    for text, a, b in zip(texts, starts[:-1], starts[1:], strict=True):
        assert ids[a:b].tolist() == own.encode(text, add_special_tokens=False).ids, text


def test_a_normalizing_tokenizer_gets_whole_texts():
    assert C.ByteLevel(SOURCE, False).begin == b" \t\n"
    changed = SOURCE.replace(b'"normalizer":null', b'"normalizer":{"type":"NFC"}').replace(
        b'"normalizer": null', b'"normalizer": {"type": "NFC"}')
    assert changed != SOURCE and C.ByteLevel(changed, False).begin == b""


def test_round_trip(spark, documents, prose):
    rows = [(3 * i - 20, t) for i, t in enumerate(ODD)] + [(500, None), (501, prose(4000)),
                                                         (7_000_000_000, prose(30, 2))]
    shuffled = rows[::2] + rows[1::2]
    folder = shared_folder(spark, "files")
    found = by_id(T.token_files(documents([*shuffled, (None, "no id")]), folder, SOURCE, 2,
                                target=2_000))
    start = 0
    for i, text in sorted(rows):
        ids = whole(text or "") + [2]
        assert found[i].start == start and found[i].n_tokens == len(ids)
        assert np.frombuffer(found[i].tokens, "<u4").tolist() == ids
        start += len(ids)
    assert len(found) == len(rows)
    tables = T.seek_tables(spark, folder).orderBy("first_id").collect()
    assert len(tables) > 1 and sum(t.n_documents for t in tables) == len(rows)

    content = max((bytes(r.content) for r in spark.read.format("binaryFile").load(folder).collect()),
                  key=len)
    # any reader of the compression reads all ids, and passes the table over
    plain = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    table = T.TokenFile(content)
    assert len(plain) == table.sizes.sum()
    assert struct.unpack("<I", content[-4:])[0] == 0x8F92EAB1


def test_only_wanted_documents_are_decompressed(spark, documents, monkeypatch):
    folder = shared_folder(spark, "wanted")
    T.token_files(documents([(i, f"text {i}") for i in range(40)]), folder, SOURCE, 2).count()
    found = by_id(T.read_files(spark, folder, [7, 31, 99]), "id")
    assert sorted(found) == [7, 31]
    content = next(bytes(r.content) for r in spark.read.format("binaryFile").load(folder).collect()
                   if r.length)
    table = T.TokenFile(content)
    damaged = bytearray(content)
    damaged[table.places[5] + 8] ^= 1
    other = T.TokenFile(bytes(damaged))
    reader = zstandard.ZstdDecompressor()
    assert other.tokens(6, reader) == table.tokens(6, reader)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        other.tokens(5, reader)
    wrong = T.TokenFile(content)
    wrong.checksums = wrong.checksums + 1
    with pytest.raises(ValueError):
        wrong.tokens(0, reader)
    with pytest.raises(ValueError):
        T.TokenFile(content[:-1] + b"x")


def test_empty_table(spark, documents):
    found = T.token_files(documents([]), shared_folder(spark, "none"), SOURCE, 2)
    assert found.columns == ["doc_id", "start", "n_tokens", "tokens"] and found.count() == 0


def test_checksum_of_the_query(spark, documents):
    found = T.token_files(documents([(1, "one two")]), shared_folder(spark, "crc"), SOURCE, 2)
    ids = np.array(whole("one two") + [2], "<u4").tobytes()
    assert found.select(F.crc32("tokens")).first()[0] == zlib.crc32(ids)


def test_the_library_is_given_bounded_texts():
    own = C.ByteLevel(SOURCE, True)
    texts = [b" word%d" % k * 900 for k in range(120)]
    want, sizes = [e.ids for e in own.tokenizer.encode_batch([t.decode() for t in texts])], []

    class Watched:
        def encode_batch_fast(self, given, **how):
            sizes.append(sum(map(len, given)))
            return library.encode_batch_fast(given, **how)

    library, own.tokenizer = own.tokenizer, Watched()
    assert own._ids(texts) == want and own._ids([]) == []
    assert len(sizes) > 3 and max(sizes) <= (1 << 17) + max(map(len, texts))


def test_frequent_chunks_stay_remembered():
    import pyarrow as pa
    own, asked = C.ByteLevel(SOURCE, False), []

    def encode(chunks):
        asked.extend(chunks.to_pylist())
        return own.encode(chunks)

    remembered, often = C.Remembered(encode, 60), [b" often%d" % i for i in range(20)]
    for turn in range(9):
        chunks = often + [b" rare%d,%d" % (turn, i) for i in range(15)] + [b"x\xc2\xa0", b"\n"][:turn % 3]
        lists, places = remembered(pa.array(chunks, pa.large_binary()))
        assert [lists[i].as_py() for i in places.tolist()] == [whole(c.decode()) for c in chunks]
        assert len(remembered.known) <= 60
    assert all(asked.count(c) == 1 for c in often)
