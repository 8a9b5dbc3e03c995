"""The pipeline's stages and the operators' hard cases against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from palimpsest.llm import ann, bpe, common, decontaminate, jaccard, license_scan, recompression, suffix_dedup, toxicity, warc

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


def _words(rng, n, vocab=400):
    return [f"w{rng.randrange(vocab)}x{rng.randrange(3)}" for _ in range(n)]


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], COLUMNS)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    base = [(i, " ".join(_words(rng, rng.randint(1, 120)))) for i in range(60)]
    passage = " ".join(_words(rng, 60))
    base += [(100 + i, f"{' '.join(_words(rng, 30))} {passage} {' '.join(_words(rng, 25))}") for i in range(5)]
    near = _words(rng, 100)
    for i in range(30):  # near copies of one text: each is close to it, few to one another
        copy = list(near)
        for p in rng.sample(range(100), 2):
            copy[p] = f"edit{i}x{p}"
        base.append((200 + i, " ".join(copy)))
    base += [(190, " ".join(near)), (300, base[0][1]), (301, base[0][1]), (302, ""), (303, None), (304, "  \t"), (0, base[0][1]), (0, base[0][1]), (0, "another text under one id")]
    return base


def _sets(rows):
    out = []
    for _, t in rows:
        w = (t or "").encode().split()
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def _components(rows):
    """Smallest row number reachable by links, of every row with words."""
    sets, parent = _sets(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(rows))], sets


def test_near_duplicates_of_a_large_group(spark, rows):
    comp, sets = _components(rows)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[comp[k]] = min(least.get(comp[k], i), i)
    want = Counter((i, len(s), least[c] if s else i) for (i, _), s, c in zip(rows, sets, comp, strict=True))
    got = Counter(tuple(r) for r in jaccard.near_duplicates(_docs(spark, rows)).collect())
    assert got == want and sum(1 for c in comp if least[c] == 190) == 31


@pytest.mark.parametrize("least", [1, 10**9])
def test_components_of_a_star_and_a_path(spark, monkeypatch, least):
    monkeypatch.setattr(common, "HOT_ROWS", least)
    links = [(50, i) for i in range(100, 300)] + [(50, 3)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 6)]
    got = {r["node"]: r["comp"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {n: 3 for n in [3, 50, *range(100, 300)]} | {n: 1000 for n in range(1000, 1041)} | {6: 6, 7: 6}
    assert got == want


def test_one_row_of_each_group_stays(spark, rows):
    comp, sets = _components(rows)
    docs = _docs(spark, rows).withColumn("_kept", F.lit("own")).withColumn("k_id", F.lit(1)).withColumn("th", F.lit(2))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    groups = {}
    for (i, t), s, c in zip(rows, sets, comp, strict=True):
        if s:
            groups.setdefault(c, []).append((i, t))
    assert len([x for x in got if x[1] and x[1].split()]) == len(groups)
    for members in groups.values():
        assert sum(m in got for m in set(members)) == 1 and min(i for i, _ in members) in [i for i, t in got if (i, t) in members]
    assert Counter(x for x in got if not (x[1] or "").split()) == Counter((i, t) for i, t in rows if not (t or "").split())


def _covered(texts, n):
    """Which bytes of each text repeated strings of n bytes cover."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        cut = np.zeros(len(d), bool)
        for i in range(len(d) - n + 1):
            if seen[d[i : i + n]] > 1:
                cut[i : i + n] = True
        out.append(cut)
    return data, out


def test_both_lengths_of_repeats(spark, rows):
    some = [r for r in rows if r[0] < 210]
    data, long = _covered([t for _, t in some], 400)
    _, short = _covered([t for _, t in some], suffix_dedup.PASSAGE)
    want = Counter((i, len(d), int(a.sum()), int(b.sum())) for (i, _), d, a, b in zip(some, data, long, short, strict=True))
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_passage_bytes"]) for r in suffix_dedup.remove_repeats(_docs(spark, some)).collect())
    assert got == want and any(b and not a for _, _, a, b in want)


@pytest.mark.parametrize("hot", [1, 3])
def test_hot_anchors_are_parted(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(common.blocks, "__defaults__", (None, 1500))
    rng = random.Random(12)
    passage = " ".join(_words(rng, 55))
    unit = " ".join(_words(rng, 30))
    some = [r for r in rows if r[0] < 120] + [(400 + i, f"{' '.join(_words(rng, rng.randrange(40)))} {passage} {' '.join(_words(rng, rng.randrange(40)))}") for i in range(25)]
    some += [(500 + i, f"{unit} " * (3 + i) + " ".join(_words(rng, 20))) for i in range(6)]
    data, long = _covered([t for _, t in some], 400)
    _, short = _covered([t for _, t in some], suffix_dedup.PASSAGE)
    want = Counter((i, len(d), int(a.sum()), int(b.sum())) for (i, _), d, a, b in zip(some, data, long, short, strict=True))
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_passage_bytes"]) for r in suffix_dedup.remove_repeats(_docs(spark, some).repartition(6)).collect())
    assert got == want


def test_all_periods_of_a_text(spark):
    rng = random.Random(5)
    units = {p: "".join(rng.choice("abcdefgh ") for _ in range(p)) for p in [*range(1, 40), *range(100, 1001, 37), 255, 256, 257, 511, 512, 513]}
    rows = [(p, (u * (2000 // p + 3))[: 3 * p + 700]) for p, u in units.items()]
    data, cut = _covered([t for _, t in rows], 400)
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(_docs(spark, rows)).collect()}
    assert got == {p: int(c.sum()) for (p, _), c in zip(rows, cut, strict=True)} and all(got.values())


def test_cut_documents_keeps_columns(spark, rows):
    some = [r for r in rows if 90 < r[0] < 210 or r[1] is None or not r[1].strip()]
    docs = _docs(spark, some).withColumnsRenamed({"lang": "_id", "source": "_spans"}).withColumn("k_th", F.lit(5))
    cut = suffix_dedup.cut_documents(docs, 300)
    assert cut.columns == docs.columns
    data, gone = _covered([t for _, t in some], 300)
    want = Counter((i, None if t is None else bytes(np.frombuffer(d, np.uint8)[~g]).decode()) for (i, t), d, g in zip(some, data, gone, strict=True))
    got = cut.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == want and all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
    assert suffix_dedup.cut_documents(docs.limit(0)).count() == 0


def test_substring_dedup_over_many_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(common.blocks, "__defaults__", (None, 2000))  # many blocks, and several buckets of marks
    docs = _docs(spark, [r for r in rows if r[0] > 0]).repartition(7)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in recompression.remove_later_copies(docs).collect()}
    seen, want = set(), {}
    for i, t in sorted((r for r in rows if r[0] > 0), key=lambda r: r[0]):
        w = (t or "").encode().split()
        cut = np.zeros(len(w), bool)
        for s in range(len(w) - 19):
            if tuple(w[s : s + 20]) in seen:
                cut[s : s + 20] = True
            seen.add(tuple(w[s : s + 20]))
        want[i] = (len(w), int(cut.sum()))
    assert got == want


def test_symbols_of_equal_strings_are_equal():
    rng = random.Random(2)
    same = [common.WordHashes()[w.encode()] for w in _words(rng, 60)]
    sides = [[rng.randrange(1, 2**63) for _ in range(n)] for n in (3, 9, 17, 4)]
    bar = int(recompression.BAR)
    one, two = (np.array([*a, *same, *b, bar], np.uint64) for a, b in (sides[:2], sides[2:]))
    found = []
    for text, lead in ((one, 3), (two, 17)):
        sym, low, high, _ = recompression.parse(text)
        found.append({(int(s), int(a) - lead, int(z) - lead) for s, a, z in zip(sym, low, high, strict=True) if a >= lead and z <= lead + 60})
    assert found[0] == found[1] and len(found[0]) > 10


def test_windows_go_by_their_symbol_strings():
    rng = random.Random(3)
    words = [recompression.word_hashes([w.encode() for w in _words(rng, n, 30)]) for n in (80, 25, 300)]
    words.append(np.concatenate((words[2][40:75], words[0][:30], words[2][100:160])))  # copies of parts in other surroundings
    bar = np.array([recompression.BAR])
    h = np.concatenate([x for w in words for x in (w, bar)])
    end = np.flatnonzero(h == recompression.BAR)
    begin = np.r_[0, end[:-1] + 1]
    at = np.concatenate([np.arange(a, z - recompression.WINDOW + 1) for a, z in zip(begin, end, strict=True)])
    parsed = recompression.parse(h)
    names = recompression.window_names(h, parsed, at, begin, end, int(recompression._LEFT))
    same = {}
    for p, name in zip(at, names, strict=True):
        same.setdefault(tuple(h[p : p + recompression.WINDOW]), set()).add(int(name))
    assert all(len(x) == 1 for x in same.values()) and len({x for s in same.values() for x in s}) == len(same) < len(at) - 60
    # other names of the symbols give the windows other names: the strings are made of symbols
    renamed = recompression.window_names(h, (np.where(parsed[0] == recompression.BAR, parsed[0], parsed[0] + np.uint64(2)), *parsed[1:]), at, begin, end, int(recompression._LEFT))
    assert (names != renamed).mean() > 0.9


def test_bpe_of_edge_cases(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.createDataFrame([(None, None), ("a", ""), ("a", ""), ("b", "x" * 9000), ("b", "日本 " * 50)], "doc_id string, text string")
    got = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="d").collect()
    assert sorted((r["doc_id"] or "", bytes(r["d"]).decode()) for r in got) == sorted((r["doc_id"] or "", r["text"] or "") for r in docs.collect())
    assert bpe.encode(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0
    assert bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path).where("decoded is null").count() == 0


def test_warc_digests_and_members(spark):
    rows = [(i, f"http://h/{i}", "<p>" + "ab"[i % 2] * (i // 4) + "é</p>") for i in range(40)] + [(50, None, None), (51, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_archives(pages)
    got = {r["page_id"]: r for r in warc.read_archives(archives).collect()}
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), i)
    for i, _, h in rows:
        r, body = got[i], (h or "").encode()
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode() and r["payload_bytes"] == len(body)
        assert (r["record_type"], r["refers_to"]) == (("response", None) if best[h or ""] == i else ("revisit", best[h or ""]))
    record = warc.record(7, "u", b"payload", None, False, 7)
    assert zlib.decompress(record, 31).startswith(b"WARC/1.")


def _licenses(text):
    w = [x for x in re.split(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())) if x]
    found = [(i, label) for i in range(len(w)) for p, label in license_scan.PHRASES.items() if w[i : i + len(p.split())] == p.encode().split()]
    return len(w), found


def test_license_phrases_against_brute_force(spark):
    rng = random.Random(4)
    bits = [*license_scan.PHRASES, "MIT", "license", "cc", "by-sa", "GNU  General\npublic", "Apache", "x", "é", "the software"]
    rows = [(i, " ".join(rng.choice(bits) + rng.choice(["", ".", ",", "-"]) for _ in range(rng.randint(0, 40)))) for i in range(150)] + [(200, None), (201, ""), (202, "cc by cc by")]
    for r in license_scan.summary(license_scan.scan(_docs(spark, rows))).collect():
        n, found = _licenses(dict(rows)[r["doc_id"]])
        at = [i for i, _ in found]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (n, len(found), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in found})) and set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))


def test_chains_find_edited_licenses(spark):
    mit, warranty = [t.split() for label, t in license_scan.TEMPLATES if label == "mit"][::2]
    filler = ["lorem", "ipsum"] * 30
    without = [w for w in mit if w not in ("deal", "in")]
    cut = mit[:20] + mit[25:]  # its five words 'deal in the Software without' or so are gone: both halves overlap in the file
    rows = [(1, filler + without + filler), (2, cut), (3, mit[:15]), (4, [x for w in warranty for x in (w, "zz")]), (5, warranty[:30] + ["new"] * 5 + warranty[30:] + filler + mit), (6, filler)]
    got = {r["doc_id"]: r for r in license_scan.summary(license_scan.scan(_docs(spark, [(i, " ".join(w)) for i, w in rows]))).collect()}
    assert [got[i]["labels"] for i in range(1, 7)] == ["mit", "mit", "", "", "mit", ""] and all(got[i]["base_labels"] == "" for i in got)
    assert 0.6 < got[1]["score"] < 1 and got[2]["score"] > 0.8 and got[6]["score"] == 0


def test_best_chains_against_all_chains():
    rng = random.Random(8)

    def walk(i, matches):
        """Best cover of a chain that ends in match i, by trying all before it."""
        at, place, n = matches[i]
        best = n
        for j in range(i):
            a, p, m = matches[j]
            rest = n - max(0, a + m - at, p + m - place)
            if a <= at <= a + m + license_scan.MAX_GAP and rest > 0:
                best = max(best, walk(j, matches) + rest)
        return best

    for _ in range(60):
        matches = sorted({(rng.randrange(60), rng.randrange(30), rng.randint(4, 12)) for _ in range(9)})
        assert [c for c, _, _ in license_scan.best_chains(matches)] == [walk(i, matches) for i in range(len(matches))]


def test_blocks_of_items_and_queries(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(_words(rng, 60))) for i in range(20)]
    items = [(i, " ".join(docs[i][1].split()[5:30])) for i in range(8)] + [(90, "w1 w2"), (91, None)]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = {(i, i) for i in range(8)}
    assert {(r["item_id"], r["doc_id"]) for r in decontaminate.contained_items(_docs(spark, docs), table, block_bytes=300).collect()} == want
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(_docs(spark, docs), table, block_bytes=300).collect()) == list(range(8, 20))
    x = np.random.default_rng(1).standard_normal((60, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    one = {tuple(r) for r in ann.nearest(df, df, 3).collect()}
    ann_rows, ann.QUERY_ROWS = ann.QUERY_ROWS, 7
    try:
        assert {tuple(r) for r in ann.nearest(df, df, 3).collect()} == one
    finally:
        ann.QUERY_ROWS = ann_rows


def test_toxicity_without_labels_and_of_repeated_rows(spark):
    docs = _docs(spark, [(1, "some text"), (1, "some text"), (2, None), (3, "")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.summary(toxicity.score(docs, none)).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 for r in got) and len({r["score"] for r in got}) == 1
    kept = toxicity.keep_clean(docs, none)
    assert kept.columns == docs.columns


def test_shared_folder_is_asked_for(spark):
    class Fake:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: Fake.conf)})

    with pytest.raises(ValueError, match="checkpoint.dir"):
        common.shared_dir(Fake)


def test_pipeline_end_to_end(spark, tmp_path):
    rng = random.Random(9)
    passage, item = " ".join(_words(rng, 70)), " ".join(_words(rng, 30))
    clean = [(i, " ".join(_words(rng, 90))) for i in range(120)]
    toxic = [(1000 + i, " ".join([*_words(rng, 40), "vile", "slur", "hate", *_words(rng, 10)])) for i in range(40)]
    copies = [(2000 + i, clean[3][1]) for i in range(5)]
    holders = [(3000 + i, f"{' '.join(_words(rng, 40))} {passage} {' '.join(_words(rng, 40))}") for i in range(3)]
    tainted = [(4000, f"{' '.join(_words(rng, 50))} {item} {' '.join(_words(rng, 40))}")]
    rows = [*clean, *toxic, *copies, *holders, *tainted, (5000, None), (5001, "")]
    _docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 1000)) for i, _ in clean + toxic], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, out = docs, stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left[name] = {r["doc_id"] for r in docs.collect()}
        assert name == "tokens" or docs.columns == before.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "decontamination", "tokens"]
    assert not left["toxicity"] & {i for i, _ in toxic} and left["toxicity"] >= {i for i, _ in clean} | {5000, 5001}
    assert left["toxicity"] - left["near_duplicates"] == {i for i, _ in copies} and left["suffix_dedup"] == left["near_duplicates"]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tmp_path}/suffix_dedup").collect()}
    assert all(passage[:100] not in texts[i] and texts[i].split()[0] == t.split()[0] for i, t in holders)
    assert left["suffix_dedup"] - left["decontamination"] == {4000} and left["tokens"] == left["decontamination"]
    done = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(done) == left["tokens"] and all(r["decoded_sha256"] == hashlib.sha256((texts[i] or "").encode()).hexdigest() for i, r in done.items())
