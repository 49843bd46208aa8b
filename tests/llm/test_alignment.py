import hashlib
import random
from collections import Counter, defaultdict

import messy
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from convoy.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _ends(parts):
    out, at = [], 0
    for part in parts:
        at += len(part)
        out.append(at)
    return out


def plain(rows):
    """The contract word by word, with whole texts."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in visible} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in visible)}
    docs, count = [], Counter()
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        part_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        part_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(part_a) != whole or b"".join(part_b) != whole:
            docs.append((doc, [], [], [], ""))
            continue
        ends_a, ends_b = _ends(part_a), _ends(part_b)
        shared = sorted(set(ends_a) & set(ends_b))
        links = [(i, j) for i, e in zip(ids_a, ends_a) for j, g in zip(ids_b, ends_b) if e == g] if len(ids_a) < 300 else [
            (i, j) for j, g in zip(ids_b, ends_b) for i in [dict(zip(ends_a, ids_a)).get(g)] if i is not None] if len(ids_a) < 3000 else [
            (i, j) for lookup in [dict(zip(ends_a, ids_a))] for j, g in zip(ids_b, ends_b) if (i := lookup.get(g)) is not None]
        count.update(links)
        groups, low = [], 0
        place_a, place_b = defaultdict(list), defaultdict(list)
        for ids, ends, place in ((ids_a, ends_a, place_a), (ids_b, ends_b, place_b)):
            k = 0
            for i, e in zip(ids, ends):
                while shared[k] < e:
                    k += 1
                place[k].append(str(i))
        said = ";".join(f"{','.join(place_a[k])}|{','.join(place_b[k])}" for k in range(len(shared)))
        docs.append((doc, ids_a, ids_b, links, said))
    top = Counter()
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    return Counter(
        (doc, len(ids_a), len(ids_b), said.count("|"), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
         hashlib.sha256(said.encode()).hexdigest() if said else "")
        for doc, ids_a, ids_b, links, said in docs)


def test_chunks_align_like_whole_texts():
    rng = random.Random(2)
    alphabet = " \n\t\r.,'ab<|>sZé日́ ▁ \U0001F600\x1c　ıİΣ  \n "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    texts += ["<|endoftext|> <s> <0x41>", "a\n\n  b", "  a", "\n", " ", "don't 'll", messy.LONG[:5000]]
    aligner = alignment.Aligner(A, B)
    assert aligner.splits
    assert aligner.align(texts) == [aligner.whole(t) for t in texts]


@pytest.mark.parametrize(("links", "fan_in", "parts"), [(2_000_000, 512, 4), (300, 3, 5)])
def test_tables(spark, links, fan_in, parts):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(6)
    want = plain([tuple(r) for r in df.select("doc_id", "text").collect()])
    found = alignment.align(df, A, B, links, fan_in, parts)
    assert Counter(tuple(r) for r in found.collect()) == want
    assert found.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", "string")]


def test_messy_documents(spark):
    rows = [(r[0], r[1]) for r in messy.ROWS]
    odd = [(50, "a▁b"), (51, "tab\there  two x"), (52, "\n\n"), (53, " <|endoftext|> </s>")]
    df = messy.frame(spark).select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    assert Counter(tuple(r) for r in alignment.align(df, A, B, block_links=500, fan_in=2).collect()) == plain(rows + odd)
    assert alignment.align(messy.empty(spark), A, B).count() == 0
