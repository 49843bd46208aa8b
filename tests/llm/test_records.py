import random
import struct
import zlib

import messy
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from convoy.llm import crc32c, records

PATH = public_tokenizers.path("word_bpe_49k.json")


def _plain_crc(data):
    state = 0xFFFFFFFF
    for byte in data:
        state ^= byte
        for _ in range(8):
            state = state >> 1 ^ (0x82F63B78 if state & 1 else 0)
    return state ^ 0xFFFFFFFF


def test_checksums():
    assert crc32c.crc32c([b"123456789"])[0] == 0xE3069283
    rng = random.Random(3)
    parts = [rng.randbytes(n) for n in (0, 1, 3, 4, 5, 8, 255, 256, 257, 511, 513, 5000, 70_001)]
    assert crc32c.crc32c(parts).tolist() == [_plain_crc(p) for p in parts]
    turned = _plain_crc(b"abcdefgh")
    assert crc32c.masked([b"abcdefgh"])[0] == ((turned >> 15 | turned << 17) + 0xA282EAD8) % 2**32
    assert len(crc32c.crc32c([])) == 0


def test_frames_are_checked():
    payloads = [b"", b"x" * 10, b"yz" * 5000]
    data = b"".join(records.frames(payloads))
    assert records.unframe(data) == payloads
    assert struct.unpack_from("<Q", data, 16)[0] == 10
    for at in (3, 9, 30, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(broken))
    with pytest.raises(ValueError):
        records.unframe(data[:-5])


def test_chunks_encode_like_whole_texts():
    rng = random.Random(1)
    alphabet = " \n\t\r.,'ab<|>sZé日́ ▁ \U0001F600\x1c　ıİΣ  \n "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["<|endoftext|> a <|startoftext|>b", "don't 'll we've", "a<|endoftext|>b", messy.LONG]
    plain = Tokenizer.from_file(PATH)
    want = [np.array(e.ids, "<u2").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert records.ChunkEncoder(PATH).encode(texts) == want


def test_letter_case_is_learned_once():
    texts = ["Wordé wordÉ\nWORDÉ", "wordé", "", "a<|ENDOFTEXT|>B <|endoftext|> C", "µ ÀÖØÞ ÿ ß ẞ İ ΑΣ K", "Z\u00a0\x85Z"]
    plain, encoder = Tokenizer.from_file(PATH), records.ChunkEncoder(PATH)
    assert encoder.encode(texts) == [np.array(e.ids, "<u2").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode([]) == []
    assert [piece for piece in encoder.known if piece.lower() == "wordé"] == ["wordé"]


def _expected(rows, end=1):
    plain, out, start = Tokenizer.from_file(PATH), [], 0
    for doc, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, start, ids))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('records')}"
    records.write_records(messy.frame(spark).repartition(3), folder, PATH, 1, file_bytes=5000, range_bytes=100_000)
    return folder


def test_messy_documents(spark, written):
    found = [(r.doc_id, r.start, list(r.ids)) for r in records.read_records(spark, written).orderBy("start").collect()]
    assert [d for d, _, _ in found] == sorted((r[0] for r in messy.ROWS), key=lambda d: (d is not None, d or 0))
    # Ties of the id stand in order of a hash of the text, so the texts of equal ids are told by their ids.
    by_id = {}
    for r in messy.ROWS:
        by_id.setdefault(r[0], []).append([*Tokenizer.from_file(PATH).encode(r[1] or "", add_special_tokens=False).ids, 1])
    start = 0
    for doc, at, ids in found:
        assert at == start and ids in by_id[doc]
        by_id[doc].remove(ids)
        start += len(ids)
    digests = {(r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in records.read_digests(spark, written).collect()}
    assert digests == {(at, doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for doc, at, ids in found}


def test_files_and_shuffled_reads(spark, written):
    files = spark.read.parquet(f"{written}/files")
    assert files.count() > 2
    index = spark.read.parquet(f"{written}/index").orderBy("number", "offset").collect()
    assert sum(r.n_tokens for r in index) == files.agg({"n_tokens": "sum"}).first()[0]
    straight = sorted((r.start, list(r.ids)) for r in records.read_records(spark, written).collect())
    orders = []
    for seed in (1, 1, 2):
        rows = [(r.start, list(r.ids)) for r in records.read_shuffled(spark, written, seed, 1).collect()]
        assert sorted(rows) == straight
        orders.append([start for start, _ in rows])
    assert orders[0] == orders[1] != orders[2] and orders[0] != sorted(orders[0])


def test_lost_attempts_do_not_count(spark, written):
    root = written.removeprefix("file://")
    with open(f"{root}/data/00000000-000000-deadbeef0000.rec", "wb") as stray:
        stray.write(b"half a record")
    assert records.read_records(spark, written).count() == len(messy.ROWS)


def test_empty_table(spark, tmp_path):
    records.write_records(messy.empty(spark), f"file://{tmp_path}", PATH, 1)
    out = records.read_digests(spark, f"file://{tmp_path}")
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == 0


def test_query_against_plain_version(spark):
    from convoy.llm.queries import op11_binary_records

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {(d, s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, s, i in _expected(sorted(map(tuple, rows)))}
    found = op11_binary_records(spark, "/root/testdata/sf0.001")
    assert found.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert {tuple(r) for r in found.collect()} == want
