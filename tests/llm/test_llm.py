"""The corpus operators against brute force, on small tables with nulls, ties, repeated rows and clashing columns."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from palimpsest.llm import ann, bpe, decontaminate, jaccard, license_scan, recompression, sharding, suffix_dedup, toxicity, warc

DOC = "doc_id long, text string, th string, _r_doc_id string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOC)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    rows = [(i, text(rng.randint(0, 160))) for i in range(40)]
    passage = text(90)
    rows += [(50 + i, text(30) + " " + passage + " " + text(20)) for i in range(6)]
    rows += [(60, rows[3][1]), (61, rows[41][1]), (62, "ab " * 400), (63, ""), (64, None), (None, text(40))]
    near = rows[5][1].split()
    rows += [(70, " ".join(near[:-2] + ["zz", "yy"]))]
    return rows


def test_suffix_dedup(spark, corpus):
    docs = _docs(spark, corpus)
    got = Counter((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.summary(suffix_dedup.remove_repeats(docs)).collect())
    data = [(t or "").encode() for _, t in corpus]
    seen = Counter(b[i : i + 400] for b in data for i in range(len(b) - 399))
    want = Counter()
    for b in data:
        cut = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                cut[i : i + 400] = True
        runs = int((np.diff(np.r_[0, cut.astype(int)]) == 1).sum())
        want[(len(b), int(cut.sum()), runs, hashlib.sha256(bytes(x for x, c in zip(b, cut, strict=False) if not c)).hexdigest())] += 1
    assert got == want


def test_suffix_dedup_of_periodic_text(spark):
    rng = random.Random(5)
    unit = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = [(p, unit(p) * 5) for p in (255, 256, 257)] + [(1000 + p, unit(700) + unit(p) * 4 + unit(700)) for p in (255, 256, 257)]
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(_docs(spark, rows)).collect()}
    seen = Counter(t[i : i + 400] for _, t in rows for i in range(len(t) - 399))
    want = {}
    for i, t in rows:
        cut = np.zeros(len(t), bool)
        for a in range(len(t) - 399):
            if seen[t[a : a + 400]] > 1:
                cut[a : a + 400] = True
        want[i] = int(cut.sum())
    assert min(want.values()) >= 4 * 255 and got == want


def test_recompression(spark, corpus):
    docs = _docs(spark, corpus)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_removed"], r["kept_sha256"]) for r in recompression.summary(recompression.remove_later_copies(docs)).collect())
    seen, want = set(), []
    for i, t in sorted(((-1 if i is None else i), t) for i, t in ((i, t or "") for i, t in corpus)):
        w = t.encode().split()
        cut = np.zeros(len(w), bool)
        for s in range(len(w) - 19):
            k = tuple(w[s : s + 20])
            if k in seen:
                cut[s : s + 20] = True
            seen.add(k)
        want.append((i, len(w), int(cut.sum()), hashlib.sha256(b" ".join(x for x, c in zip(w, cut, strict=True) if not c)).hexdigest()))
    assert got == sorted(want)


def test_jaccard(spark, corpus):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(_docs(spark, corpus)).collect()}
    sets = []
    for i, t in corpus:
        w = (t or "").split()
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    key = lambda i: -1 if i is None else i
    comp = {i: i for i, _ in sets}
    for _ in range(len(sets)):
        for i, a in sets:
            for j, b in sets:
                if a and b and 100 * len(a & b) >= 75 * len(a | b) and key(comp[j]) < key(comp[i]):
                    comp[i] = comp[j]
    assert got == {i: (len(s), comp[i]) for i, s in sets}


def test_decontamination(spark, corpus):
    items = spark.createDataFrame([(1, corpus[3][1]), (2, "not there at all in any text"), (3, None), (4, "")], "item_id long, text string")
    got = {(r["item_id"], r["doc_id"]) for r in decontaminate.contained_items(_docs(spark, corpus), items, block_bytes=10).collect()}
    assert got == {(1, 3), (1, 60)}
    assert decontaminate.keep_clean(_docs(spark, corpus), items).count() == len(corpus) - 2


def test_bpe_round_trip_against_tiktoken(spark, corpus):
    import base64

    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = [*corpus, (99, "Hello  wörld\t\n 123's it’s aaaaaaa 日本語 <|endoftext|>")]
    tokens = bpe.decode(bpe.encode(_docs(spark, rows), path, public_tokenizers.PATTERN), path)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: (t or "") for i, t in rows}
    for r in tokens.collect():
        assert list(r["ids"]) == ref.encode_ordinary(want[r["doc_id"]]) and bytes(r["decoded"]).decode() == want[r["doc_id"]]


def test_sharding(spark, corpus):
    rows = sharding.shard_by_bytes(_docs(spark, corpus + corpus[:3]), 4).collect()
    assert len(rows) == len(corpus) + 3
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(4))
    sums = Counter()
    for r in rows:
        sums[r["shard"]] += r["size"]
    groups = {}
    for i, t in corpus + corpus[:3]:
        g = groups.setdefault(t, [-1 if i is None else i, 0])
        g[0], g[1] = min(g[0], -1 if i is None else i), g[1] + 8 + len((t or "").encode())
    sizes = [s for _, s in sorted(groups.values())]

    def fits(c):
        n, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                n, room = n + 1, c
            room -= s
        return n <= 4

    assert max(sums.values()) == next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b/é", None), (4, "u", ""), (5, "u", "y" * 100_000), (5, "u", "y" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_archives(warc.write_archives(pages)).collect())
    assert got == [(1, 8, "revisit", 2), (2, 8, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (5, 100_000, "response", None), (5, 100_000, "response", None)]
    bad = warc.record(1, "u", b"abc", None, False, 6)
    with pytest.raises(ValueError):
        import io

        list(warc.members(io.BytesIO(bad[:-3]), "p"))
    import zlib

    with pytest.raises(ValueError):
        warc.parse(zlib.decompress(bad, 31).replace(b"abc", b"abd"), "p")


def test_license_scan(spark):
    mit = dict(license_scan.TEMPLATES)["mit"]
    rows = [(1, "under the MIT License, cc-by! " + "w " * 5), (2, "x " * 50 + mit + " y"), (3, None), (4, "the apache  license and GNU general public license")]
    got = {r["doc_id"]: r for r in license_scan.summary(license_scan.scan(_docs(spark, rows))).collect()}
    assert (got[1]["base_labels"], got[1]["first_word"], got[1]["last_word"], got[1]["n_base"]) == ("cc-by,mit", 2, 4, 2)
    assert got[2]["labels"] == "mit" and got[2]["base_labels"] == "" and got[2]["score"] > 0.9
    assert (got[3]["n_words"], got[3]["first_word"], got[3]["score"]) == (0, None, 0.0)
    assert got[4]["base_labels"] == "apache,gpl"


def test_toxicity_neighbours_are_exact_and_scores_learn(spark):
    rng = random.Random(1)
    clean = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        words = [rng.choice(clean).replace("w", "".join(rng.choice("abcde") for _ in range(3))) for _ in range(30)]
        rows.append((i, " ".join([*words, *(["badword"] if i % 5 == 0 else [])])))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    out = toxicity.summary(toxicity.score(_docs(spark, [*rows, (999, None)]), labels)).collect()
    held = [r for r in out if r["held_out"] and r["doc_id"] != 999]
    assert held and all(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held)
    texts, toxic = [t for _, t in rows], [int(i % 5 == 0) for i, _ in rows]
    vocab = sorted({f for t in texts for f in toxicity.terms(t)})[:400]
    index = toxicity.Index(vocab, np.ones(len(vocab)), texts, list(range(300)), toxic, 0.2)
    for text in texts[:20]:
        t, w = index.vector(text)
        dense = np.zeros(index.n)
        for e in range(index.n):
            et, ew = index.vector(texts[index.ids[e]])
            dense[e] = sum(a * b for i, a in zip(t, w, strict=True) for j, b in zip(et, ew, strict=True) if i == j)
        best = np.sort(dense)[::-1][: toxicity.NEIGHBOURS]
        assert np.allclose(index.nearest(t, w)[1], best[best > 0])


def test_ann_recall_and_cases(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 16)).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [1.0] * 8), (7, x[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.where("vec_id % 50 = 0")).collect()
    hit = 0
    for q in range(0, 400, 50):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert len(mine) == 10 and all(abs(d[v] - s) < 1e-12 for _, v, s in mine)
        hit += len({v for _, v, _ in mine} & set(np.argsort(d)[:10].tolist()))
    assert hit >= 0.9 * 80 and all(r["query_id"] < 400 and r["vec_id"] < 400 for r in got)


@pytest.mark.parametrize("moved", [0.0, 1e-3], ids=["copies", "own vectors"])
def test_ann_of_an_id_with_many_rows(spark, moved):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 16))
    x[1] = x[0] + 0.01
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1, (x[1] + moved * j / 150 * rng.standard_normal(16)).tolist()) for j in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.where("vec_id in (0, 100)")).collect()
    for q in (0, 100):
        best = {}
        for i, v in rows:
            if i != q:
                best[i] = min(best.get(i, np.inf), float(np.sqrt(((np.array(v) - x[q]) ** 2).sum())))
        mine = {r["vec_id"]: r["score"] for r in got if r["query_id"] == q}
        assert len(mine) == 10 and all(abs(best[i] - s) < 1e-12 for i, s in mine.items())
        assert len(set(mine) & set(sorted(best, key=best.get)[:10])) >= 9


def test_empty_tables(spark):
    docs, labels = _docs(spark, []), spark.createDataFrame([], "doc_id long, toxic int")
    assert suffix_dedup.remove_repeats(docs).count() == 0
    assert recompression.remove_later_copies(docs).count() == 0
    assert jaccard.near_duplicates(docs).count() == 0
    assert sharding.shard_by_bytes(docs).count() == 0
    assert toxicity.score(docs, labels).count() == 0
    assert license_scan.scan(docs).count() == 0
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(vectors, vectors).count() == 0
    assert decontaminate.contained_items(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
