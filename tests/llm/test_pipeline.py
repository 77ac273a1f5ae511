import duckdb
import pytest

import corpus_pipeline as cp
from millrace.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    names = [name for name, _ in cp.STAGES]
    assert names == ["quality_rules", "language_id", "near_duplicates", "source_mixing", "packing"]
    for i, (_, stage) in enumerate(cp.STAGES[:-1]):
        out = cp.stored(stage(spark, docs, SF), "t")
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert out.select("doc_id").distinct().count() == out.count() <= n
        assert out.exceptAll(docs).count() == 0, i
        docs, n = out, out.count()
    packed = cp.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert packed.count() == cp.run(spark, SF).count()


def test_stages_on_odd_and_empty_tables(spark, odd, none):
    for docs in (odd.select(*cp.COLUMNS), none.select(*cp.COLUMNS)):
        for _, stage in cp.STAGES:
            assert stage(spark, docs, SF).count() <= docs.count() * 2000


@pytest.mark.parametrize("name", list(Q.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(Q.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = Q.queries()[name](spark, SF).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def slow_quality(rows):
    """Rows that the rules keep: counts text by text, the vote model of all rows, a posterior each."""
    import re
    from collections import Counter

    import numpy as np

    from millrace.llm import quality

    def votes(t):
        raw, words = t.encode(), re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        repeats = len({j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)})
        n, chars = len(words), sum(map(len, words))
        size, letters, upper = max(n, 1), sum(chr(b).isalpha() and b < 128 or b >= 128 for b in raw), sum(65 <= b <= 90 for b in raw)
        marks = sum(33 <= b < 127 and not chr(b).isalnum() for b in raw)
        stops, twice = t.count(". ") + t.count(".\n") + t.endswith("."), len(lines) - len(set(lines))
        symbols, different, length = sum(t.count(c) for c in "#*$%&|<>"), len(set(words)), chars / size
        of = lambda bad, good=False: -1 if bad else int(good)
        return n >= 10 and 100 * repeats <= 20 * n, (
            of(symbols > 0.1 * size, symbols <= 0.01 * size), of(upper / max(letters, 1) > 0.3), of(marks / max(chars, 1) > (0.25 if n < 40 else 0.12)), of(repeats > 0.2 * size),
            of(twice > 0.5 * len(lines) and len(lines) > 2), of(n >= 30 and different <= 0.2 * size, n >= 40 and different > 0.35 * size), of(length < 2 or length > 15),
            of(n >= 40 and letters / max(chars, 1) < 0.7), of(n >= 40 and stops * 100 < n, stops * 40 > n and stops * 2 < n),
        )

    judged = [votes(r.text or "") for r in rows]
    seen = Counter(v for _, v in judged)
    model = quality.fit_votes(np.array(list(seen)), np.array(list(seen.values()), float))
    odds = lambda v: model["prior"] + sum(model["odds"][k, int(x == 1)] for k, x in enumerate(v) if x)
    return [r for r, (base, v) in zip(rows, judged, strict=True) if base and odds(v) >= 0]


def slow_tongue(texts):
    """A function that tells a text's language and score, from labelled texts; shares no code with the operator."""
    import math
    import unicodedata

    def words_of(text):
        out = [""]
        for c in text.lower():
            if unicodedata.category(c)[0] == "L":
                out[-1] += c
            elif out[-1]:
                out.append("")
        return [w for w in out if w]

    def grams(word, size):
        marked = word if size == 1 else "^" + word + "$"
        return [marked[i : i + size] for i in range(len(marked) - size + 1)]

    langs, count, total, known = sorted({k for k, _ in texts}), {}, {}, [set() for _ in range(6)]
    for lang, text in set(texts):
        for w in words_of(text):
            for size in range(6):
                for e in [w] if size == 0 else grams(w, size):
                    count[lang, size, e] = count.get((lang, size, e), 0) + 1
                    total[lang, size] = total.get((lang, size), 0) + 1
                    known[size].add(e)

    def log(lang, size, e):
        return math.log(count.get((lang, size, e), 0) + 0.5) - math.log(total.get((lang, size), 0) + 0.5 * (len(known[size]) + 1))

    memo = {}

    def of_word(w):
        if w not in memo:
            memo[w] = None
            for size, es in [(0, [w])] + [(size, grams(w, size)) for size in (5, 4, 3, 2, 1)]:
                found = [e for e in es if e in known[size]]
                if found:
                    memo[w] = [sum(log(k, size, e) for e in found) / len(found) for k in langs]
                    break
        return memo[w]

    def tell(text):
        words = words_of(text or "")
        if not words or not langs:
            return "und", 0.0
        said = [s for s in map(of_word, words) if s is not None]
        mean = [sum(s[i] for s in said) / len(said) for i in range(len(langs))] if said else [0.0] * len(langs)
        best = max(range(len(langs)), key=lambda i: (mean[i], -i))
        return langs[best], 1 / sum(math.exp(x - mean[best]) for x in mean)

    return tell


def slow_language(rows):
    """Rows whose language is told with a score of one half."""
    import zlib

    tell = slow_tongue([(r.lang, r.text) for r in rows if r.lang and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1])
    return [r for r in rows if (got := tell(r.text))[0] != "und" and got[1] >= 0.5]


def slow_mix(rows, block=8):
    """Rows in the order of the mix: blocks of a source put to the slots of one hyperperiod after the other."""
    from millrace.llm import mixing

    by = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        by.setdefault(r.source, []).append(r)
    slots = mixing.whole_shares(mixing.tempered({k: len(v) for k, v in by.items()}, 0.9))
    order, at, out = mixing.pfair(slots), dict.fromkeys(by, 0), []
    while len(out) < len(rows):
        for k in order:
            out += by[k][at[k] : at[k] + block]
            at[k] += block
    return out


def test_pipeline_against_brute_force(spark):
    import zlib

    import numpy as np
    import public_tokenizers
    from test_search_join_lm import slow_join
    from tokenizers import Tokenizer

    from millrace.llm import packing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, got = docs.collect(), docs

    def slow_near(rows):
        first = {c for _, _, c, _ in slow_join([(r.doc_id, r.text) for r in rows])}
        return [r for r in rows if r.doc_id in first]

    for (_, stage), slow in zip(cp.STAGES[:-1], (slow_quality, slow_language, slow_near, slow_mix), strict=True):
        got, before = cp.stored(stage(spark, got, SF), "t"), len(rows)
        rows = slow(rows)
        assert 0 < len(rows) <= before
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, rows), key=str)
    # in the order of the mix, files by name
    assert [r.doc_id for r in cp.source_mixing(spark, got, SF).collect()] == [r.doc_id for r in rows]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for r in rows:
        ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[r.doc_id, k // 2048] = (k, len(part), zlib.crc32(part.tobytes()))
    packed = cp.STAGES[-1][1](spark, got, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in packed} == want and len(packed) == len(want)
    # sequences are numbered in the order of the mix, by the first piece that each holds
    place, first = {r.doc_id: k for k, r in enumerate(rows)}, {}
    for r in packed:
        first.setdefault(r.sequence_id, []).append((place[r.doc_id], r.piece))
    order = [min(first[s]) for s in sorted(first)]
    assert order == sorted(order)
    unmixed = cp.STAGES[-1][1](spark, cp.stored(got.orderBy("doc_id"), "t"), SF).collect()  # as without the mixing stage
    numbers = lambda found: [r.doc_id for r in sorted(found, key=lambda r: (r.sequence_id, r.offset))]
    assert numbers(unmixed) != numbers(packed)
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 2048
    sizes = packing.Counter(n for _, n, _ in want.values())
    assert packing.lower_bound(sizes, 2048) <= len(bins) <= sum(n for _, n in packing.best_fit(sizes, 2048))
