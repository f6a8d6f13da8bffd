import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quarryline.llm import alignment
from quarryline.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def spans(pieces):
    out, at = [], 0
    for raw in pieces:
        out.append((at, at + len(raw)))
        at += len(raw)
    return out


def brute(rows):
    """Every token of one side against every token of the other."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    bs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(x): x for x in bs} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in bs)}
    docs = []
    for doc, text in rows:
        docs.append((doc, [], [], [], []))
        if not text:
            continue
        ids_a, ids_b, raw = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
        bytes_a = [bytes(back[c] for c in a.id_to_token(k)) for k in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(k)[3:-1], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            continue
        sa, sb = spans(bytes_a), spans(bytes_b)
        links = [(x, y) for x, (p, q) in zip(ids_a, sa, strict=True) for y, (r, s) in zip(ids_b, sb, strict=True) if max(p, r) < min(q, s)]
        shared, groups, low = sorted({q for _, q in sa} & {s for _, s in sb}), [], 0
        for high in shared:
            inside = lambda ids, own: ",".join(str(k) for k, (p, q) in zip(ids, own, strict=True) if low <= p and q <= high)  # noqa: B023, E731
            groups.append(f"{inside(ids_a, sa)}|{inside(ids_b, sb)}")
            low = high
        docs[-1] = (doc, ids_a, ids_b, groups, links)
    count = Counter(p for d in docs for p in set(d[4]))
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for doc, ids_a, ids_b, groups, links in docs:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else ""
        out.append((doc, len(ids_a), len(ids_b), len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), digest))
    return out


@pytest.mark.parametrize("block", [alignment.BLOCK, 300])
def test_against_brute_force(spark, block):
    rng = random.Random(5)
    words = "the of naïve übergroß 東京 don't  <|endoftext|> <s> \t\n 12345 x=1; 🙂 internationalisation 　".split(" ")
    texts = ["".join(rng.choice(words) + rng.choice([" ", "", "  ", "\n"]) for _ in range(rng.randrange(1, 40))) for _ in range(40)]
    texts += ["", None, " ", "a▁b", "nul\x00byte", "the", "the", " lead", "trail ", "é", "<0x41>", "a" * 700, "� ", "ﬁ"]
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as block", "2 as pair", "3 as places").repartition(3)
    got = alignment.align_documents(docs, A, B, block=block).collect()
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, brute(rows)))


def test_empty_table_and_no_tokens(spark):
    assert alignment.align_documents(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
    got = alignment.align_documents(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_groups_tile_the_text_and_products_expand(spark):
    text = "Donaudampfschifffahrt isn't 東京 tokenisation"
    groups = alignment.aligned_groups(spark.createDataFrame([(7, text), (8, None)], "doc_id long, text string"), A, B)
    rows = groups.orderBy("group_no").collect()
    assert {r.doc_id for r in rows} == {7} and rows[0].start == 0 and rows[-1].end == len(text.encode()) + 1
    assert all(x.end == y.start for x, y in zip(rows, rows[1:], strict=False))
    ids = Tokenizer.from_file(A).encode(" " + text).ids
    assert [i for r in rows for i in r.a_ids] == ids and max(len(r.a_ids) for r in rows) > 1
    assert alignment.group_products(groups).count() == sum(len(r.a_ids) * len(r.b_ids) for r in rows)


def test_query_on_the_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    few = {r[0]: r for r in brute([(d, (t or "")[:1500]) for d, t in rows[:60]])}
    docs = spark.createDataFrame([(d, (t or "")[:1500]) for d, t in rows[:60]], "doc_id long, text string")
    assert {r.doc_id: tuple(r) for r in alignment.align_documents(docs, A, B).collect()} == few
    out = QUERIES["op11_align"](spark, sf).collect()
    assert len(out) == len(rows) and all(r.n_groups <= min(r.n_a, r.n_b) <= r.n_links for r in out)
