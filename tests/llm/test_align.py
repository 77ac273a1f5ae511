import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def slow():
    """Groups and links of whole texts, byte offset by byte offset."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    letters = {c: b for b, c in tokenizer_letters().items()}
    entry = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in a_tok.get_vocab().items()}

    def piece(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[1:-1], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        a, b = a_tok.encode(f" {text}", add_special_tokens=False).ids, b_tok.encode(text)
        want = f" {text}".encode()
        if b"".join(map(entry.get, a)) != want or b"".join(map(piece, b)) != want:
            return []
        ends = []
        for ids, size in ((a, lambda i: len(entry[i])), (b, lambda i: len(piece(i)))):
            at, mine = 0, []
            for i in ids:
                at += size(i)
                mine.append(at)
            ends.append(mine)
        cuts, out, i, j = sorted(set(ends[0]) & set(ends[1])), [], 0, 0
        for c in cuts:
            p, q = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
            out.append((a[i:p], b[j:q]))
            i, j = p, q
        return out

    def report(rows):
        all_ = [(i, groups(t)) for i, t in rows]
        links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in all_]
        count = Counter(p for one in links for p in one)
        best = defaultdict(int)
        for (x, _), n in count.items():
            best[x] = max(best[x], n)
        out = []
        for (i, g), one in zip(all_, links, strict=True):
            spelt = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(one.values()), sum(n for p, n in one.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in one.items()), hashlib.sha256(spelt.encode()).hexdigest() if g else ""))
        return sorted(out, key=str), {(*p, n, n == best[p[0]]) for p, n in count.items()}

    return report


def tokenizer_letters():
    kept = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    rest = iter(range(256, 512))
    return {b: chr(b) if b in kept else chr(next(rest)) for b in range(256)}


def got(pair):
    documents, pairs = pair
    return sorted(map(tuple, documents.collect()), key=str), {tuple(r) for r in pairs.collect()}


WORDS = ["the", "naïve", "<|endoftext|>", "</s>", "<0x41>", "▁x", "日本語テキスト", "don't", "1234567", "\n", "\t\tx", "", "", "a b", "　", "…", "\U0001f600\U0001f469‍", "x" * 90, "=====", "\r\n", "é", "¡hola!", "end.\n", "\x00", "ſ", "\x1c"]


def made(rng, n):
    return [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(12)))) for i in range(n)]


def test_against_slow(spark, slow):
    rows = made(random.Random(4), 500) + [(7, "twice here"), (7, "twice here"), (None, "no id"), (900, None), (901, ""), (902, " " * 300), (903, "a" * 5000), (904, "日" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("batch", "at", "key", "base", "n", "times", "count", "best", "a_id")])
    assert got(align.align_documents(df.repartition(3), A, B)) == slow(rows)


def test_batches_share_counts(spark, slow):
    rows = made(random.Random(5), 300)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(align.align_documents(df, A, B, batch_pairs=40)) == slow(rows)


def test_odd_and_empty(odd, none, slow):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(align.align_documents(odd, A, B)) == slow(rows)
    assert got(align.align_documents(none, A, B)) == ([], set())


def test_forgets_and_learns_again(slow, monkeypatch):
    monkeypatch.setattr(align, "MOST_CHUNKS", 3)
    aligner, rng = align.Aligner(A, B), random.Random(6)
    for text in [t for _, t in made(rng, 40)]:
        (rows,) = aligner.rows_of([text])
        spelt = ";".join(aligner.groups[r] for r in rows)
        want = slow([(1, text)])[0][0]
        assert (hashlib.sha256(spelt.encode()).hexdigest() if rows else "") == want[-1]


def test_owner_groups():
    a_group, b_group, a_over, b_over = align.owner_groups(np.array([2, 3, 1]), np.array([1, 1, 4]))
    assert a_group.tolist() == [0, 1, 1] and b_group.tolist() == [0, 0, 1]
    assert list(zip(a_over.tolist(), b_over.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 2), (2, 2)]


def test_wide_groups(monkeypatch):
    rng = np.random.default_rng(7)
    a_group, b_group = np.sort(rng.integers(0, 6, 60)), np.sort(np.r_[np.arange(6), rng.integers(0, 6, 40)])
    a_group[:6] = np.arange(6)
    a_group.sort()
    a_ids, b_ids = rng.integers(0, 9, 60), rng.integers(0, 7, len(b_group))

    def counted():
        out = Counter()
        for k, n, g in zip(*(x.tolist() for x in align.group_links(a_group, b_group, a_ids, b_ids, 10)), strict=True):
            out[g, k] += n
        return out

    plain = counted()
    monkeypatch.setattr(align, "WIDE", 20)
    assert counted() == plain


def test_groups_of_texts(spark):
    rows = {r.doc_id: r.groups for r in align.spelt_groups(spark.createDataFrame([(1, "Hello there wörld"), (2, None)], "doc_id long, text string"), A, B).collect()}
    assert rows[2] == [] and rows[1][0].start == 0 and all(g.a and g.b for g in rows[1])
