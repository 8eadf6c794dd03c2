"""The ten operators and the pipeline against brute force, on small tables and edge cases."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import bpe, components, fingerprint, kernel, linededup, lm, neardup, packing, quality, queries, shared, tokens, toxicity, urlfilter, wavelet

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


#: Nulls, empty and blank texts, repeated rows, equal texts, no spaces, odd white space, other scripts.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c"), (4, "a b c"), (5, "a b c"), (None, "a b c"), (None, None), (6, "x" * 9000), (7, "日本 語 é \x85 !"), (8, "<|endoftext|> it's\n\n  two"), (-3, "A B C")]


def words(t):
    return (t or "").encode().split()


def run_all(spark, sf, frame, tmp):
    """Every query over a folder whose documents are ``frame``."""
    frame.write.parquet(f"{tmp}/documents.parquet")
    for t in ("labels", "pages"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{tmp}/{t}.parquet")
    return {n: f(spark, str(tmp)) for n, f in queries.queries().items()}


def test_odd_rows_and_clashing_columns(spark, sf, tmp_path):
    odd = table(spark, ODD).select("*", *[F.lit(1).alias(c) for c in ("score", "kept", "rid", "range", "ghost", "part", "removed", "n_words", "row")])
    got = run_all(spark, sf, odd, tmp_path)
    for name, df in got.items():
        n = df.count()
        if name not in ("op2_url_filter", "op6_packing", "pipeline"):
            assert n == len(ODD), name


def test_empty_tables(spark, sf, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    for name, f in queries.queries().items():
        assert f(spark, str(tmp_path)).count() == 0, name


def test_words_and_shingles():
    import pyarrow as pa

    given = ["a b A", "", None, "x", " a  b\n c d ", "éé b\x85c a b"]
    lo, hi, data, offsets = next(kernel.blocks(pa.array(given)))
    w = kernel.Words(data, offsets)
    found = [[bytes(data[a:b]) for a, b in zip(w.starts[w.first[i] : w.first[i + 1]], w.ends[w.first[i] : w.first[i + 1]])] for i in range(len(given))]
    assert found == [words(t) for t in given]
    _, first = kernel.shingles(w, 2)
    assert np.diff(first).tolist() == [2, 0, 0, 1, 3, 3]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (5, 5), (200, 100)] + [(300, x) for x in range(301, 400)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect())
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 101, 102, 200)} == {100} and {got[i] for i in range(300, 400)} == {300}


def brute_classes(texts, k, percent):
    sets = {}
    for i, t in texts.items():
        w = words(t.encode().lower().decode("utf-8"))
        sets[i] = set(zip(*[w[j:] for j in range(k)])) if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            x, y = sets[i], sets[j]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs, texts, k):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.similarity_classes(docs, neardup.Join(shingle=k)).collect()}
    assert got == brute_classes({i: t.translate(str.maketrans(urlfilter.UPPER, urlfilter.LOWER)) for i, t in texts.items()}, k, 80)


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 1000, 200)]
    made = []
    for i in range(400):
        w = list(base)
        for at in rng.choice(200, 8, replace=False):
            w[at] = f"e{rng.integers(1 << 30)}"
        made.append((i, " ".join(w)))
    texts = dict(made)
    got = {r["doc_id"]: r["component_id"] for r in neardup.similarity_classes(table(spark, made), neardup.Join(small=4, levels=3)).collect()}
    assert got == {i: c for i, (_, c) in brute_classes(texts, 2, 80).items()}


def test_members_on_the_edge_of_a_group(spark):
    """Texts just above the threshold to members of mid-sized groups stay linked."""
    rng = np.random.default_rng(9)
    made = []
    for g in range(6):
        base = [f"g{g}w{x}" for x in range(150)]
        for i in range(60):
            w = list(base)
            for at in rng.choice(150, 12 if i % 15 == 0 else 3, replace=False):
                w[at] = f"e{rng.integers(1 << 30)}"
            made.append((g * 100 + i, " ".join(w)))
    got = {r["doc_id"]: r["component_id"] for r in neardup.similarity_classes(table(spark, made)).collect()}
    assert got == {i: c for i, (_, c) in brute_classes(dict(made), 2, 80).items()}


def test_nodes_are_compared_in_parts():
    import pyarrow as pa

    sizes = [900, 2, 3, 900, 48, 48, 0, 1]
    lists = pa.array([list(range(n)) for n in sizes], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([lists], names=["members"])
    parts = list(neardup._bounded(iter([batch, batch.slice(0, 0)])))
    assert [len(x) for p in parts for x in p.to_pylist()] == sizes and len(parts) > 2


def test_quality_figures(docs, texts, spark, sf):
    out = quality.judge(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    for r in out:
        t = texts[r["doc_id"]]
        w = words(t)
        lines = [x for x in t.encode().split(b"\n") if x.split()]
        three = collections.Counter(zip(w, w[1:], w[2:]))
        hit = set()
        for i in range(len(w) - 2):
            if three[w[i], w[i + 1], w[i + 2]] > 1:
                hit |= {i, i + 1, i + 2}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and not (r["kept"] and r["base_failed"])


def test_quality_ratio_tells_targets_apart(spark):
    rng = np.random.default_rng(1)
    good = [(i, " ".join(f"g{x}" for x in rng.integers(0, 50, 120))) for i in range(60)]
    bad = [(i, " ".join(f"b{x}" for x in rng.integers(0, 50, 120))) for i in range(60, 90)]
    labels = spark.createDataFrame([(i, 1 if i < 40 else 0, 0) for i in (*range(40), *range(60, 70))], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in quality.judge(table(spark, good + bad), labels).collect()}
    assert all(got[i] == (i < 60) for i in got)


def test_toxicity_held_out_and_located(spark):
    rng = np.random.default_rng(2)
    made, labels = [], []
    for i in range(600):
        s = [" ".join(f"w{x}" for x in rng.integers(0, 300, 10)) for _ in range(8)]
        toxic = int(i % 3 == 0)
        if toxic:
            s[rng.integers(8)] += " vile"
        made.append((i, ". ".join(s)))
        labels.append((i, 1, toxic))
    d, lab = table(spark, made), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(d, lab.filter("doc_id < 400"))
    out = toxicity.score(d, model, carry=("doc_id", "text")).filter("doc_id >= 400").collect()
    assert all(r["predicted"] == (r["doc_id"] % 3 == 0) for r in out)
    for r in out:
        assert all("vile" in r["text"][s["start"] : s["end"]] for s in r["offending"])
    long_clean = toxicity.score(table(spark, [(1, ". ".join("w1 w2 w3" for _ in range(20000))), (2, None)]), model).collect()
    assert all(r["predicted"] == 0 and 0 <= r["score"] <= 1 for r in long_clean)


def brute_dedup(pairs, least=50):
    seen, out = {}, {}
    for i, t in sorted(pairs):
        lines = t.split("\n")
        own = [(k, x, len(words(x))) for k, x in enumerate(lines) if words(x)]
        gone = set()
        for a in range(len(own)):
            n = 0
            for b in range(a, len(own)):
                n += own[b][2]
                if n >= least:
                    break
            else:
                continue
            key = tuple(x for _, x, _ in own[a : b + 1])
            if key in seen:
                gone |= set(range(own[a][0], own[b][0] + 1))
            seen.setdefault(key, (i, a))
        out[i] = (lines, gone)
    return out


def test_line_dedup(docs, texts):
    brute = brute_dedup(texts.items())
    for r in linededup.dedup(docs).collect():
        lines, gone = brute[r["doc_id"]]
        removed = {k for s in r["removed"] for k in range(s["lo"], s["hi"] + 1)}
        assert gone <= removed
        assert r["text"] == "\n".join(x for k, x in enumerate(lines) if k not in removed)
        assert sum(len(words(lines[k])) for k in removed - gone) < 50 * max(1, len(r["removed"]))


def test_passage_goes_and_short_lines_stay(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    split = passage.replace("p20 ", "p20\n").replace("p40 ", "p40\n\n")
    made = [(1, f"one\n{split}\nshared line"), (2, f"two two\n{split}\nother end"), (3, f"shared line\n{passage}"), (4, f"{passage}\nshared line")]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup(table(spark, made)).collect()}
    assert got == {1: made[0][1], 2: "two two\nother end", 3: made[2][1], 4: ""} or got == {1: made[0][1], 2: "two two\nother end", 3: made[2][1], 4: "shared line"}


def test_passages_inside_lines(docs, texts, spark, sf):
    seen, gone = set(), {}
    for i, t in sorted(texts.items()):
        w = words(t)
        gone[i] = set()
        for a in range(len(w) - 49):
            key = tuple(w[a : a + 50])
            gone[i] |= set(range(a, a + 50)) if key in seen else set()
            seen.add(key)
    got = queries.op7_line_dedup(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert {k for s in r["removed"] for k in range(s["lo"], s["hi"] + 1)} == gone[r["doc_id"]]
        assert words(r["text"]) == [x for k, x in enumerate(words(texts[r["doc_id"]])) if k not in gone[r["doc_id"]]]
    passage = " ".join(f"p{i}" for i in range(55))
    y = " ".join(f"y{i}" for i in range(40))
    made = [(1, f"one {passage} two"), (2, f"start {passage} same line\nend"), (3, f"x\n{passage} y\n{y}"), (4, f"a {passage}\nnext"), (5, f"z {passage} y\n{y}"), (6, None), (7, passage)]
    assert {r["doc_id"]: r["text"] for r in linededup.dedup_passages(table(spark, made)).collect()} == {1: made[0][1], 2: "start same line\nend", 3: f"x\ny\n{y}", 4: "a\nnext", 5: "z", 6: None, 7: ""}


def test_tail_of_a_run_is_matched_with_any_earlier_place(spark, sf, tmp_path):
    w, y = " ".join(f"w{i}" for i in range(60)), " ".join(f"y{i}" for i in range(40))
    table(spark, [(1, w), (2, f"{w}\n{y}"), (3, f"{w}\n{y}")]).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["text"] for r in queries.op7_line_dedup(spark, str(tmp_path)).collect()} == {1: w, 2: y, 3: ""}


def test_lm(docs, texts, spark):
    tok = lambda t: [*words(t.translate(str.maketrans(urlfilter.UPPER, urlfilter.LOWER))), None]
    train = {i: t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10}
    c = collections.Counter(w for t in train.values() for w in tok(t))
    n, v = sum(c.values()), len(c)
    model = lm.fit(docs.filter(kernel.crc32_mod("doc_id", 10) != 0), small := lm.Orders(head=512, pairs=128, triples=32, grams=4096))
    out = lm.scored(docs, model, small).collect()
    for r in out:
        t = tok(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel=1e-9)
    held = [r for r in out if r["doc_id"] not in train]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("conf", [lm.Orders(head=512, pairs=128, triples=32, grams=4096), lm.Orders(head=64, pairs=16, triples=4, grams=8), lm.Orders()])
def test_lm_holds_every_gram_whatever_is_hot(docs, texts, conf):
    tok = lambda t: [*words(t.translate(str.maketrans(urlfilter.UPPER, urlfilter.LOWER))), None]
    train = [tok(t) for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    one = collections.Counter(w for t in train for w in t)
    two = collections.Counter(g for t in train for g in zip([None, *t], t))
    three = collections.Counter(g for t in train for g in zip([None, *t], t, t[1:]))
    two, three = ({g: c for g, c in x.items() if c > 1} for x in (two, three))
    total, n1, n2 = sum(one.values()), *(sum(c == k for c in one.values()) for k in (1, 2))
    d = min(max(n1 / max(1, n1 + 2 * n2), 0.1), 0.95)
    p1, p2 = {w: (c - d) / total for w, c in one.items()}, {(u, w): (c - 0.6) / one[u] for (u, w), c in two.items()}
    p3 = {g: (c - 0.6) / two[g[:2]] for g, c in three.items()}
    kept, below = collections.Counter(), collections.Counter()
    for (u, w), p in p2.items():
        kept[u] += p
        below[u] += p1[w]
    for g, p in p3.items():
        kept[g[:2]] += p
        below[g[:2]] += p2[g[1:]]
    back = {h: max(1 - kept[h], 1e-9) / max(1 - below[h], 1e-9) for h in kept}

    def weight(u, v, w):
        pair = p2.get((v, w)) or back.get(v, 1) * p1.get(w, d * len(one) / total)
        return math.log10(pair if u == "" else p3.get((u, v, w)) or back.get((u, v), 1) * pair)

    model = lm.fit(docs.filter(kernel.crc32_mod("doc_id", 10) != 0), conf)
    assert len(three) > len(model.three) or conf == lm.Orders()
    for r in lm.scored(docs, model, conf).collect():
        t = tok(texts[r["doc_id"]])
        assert r["score"] == pytest.approx(sum(weight(*g) for g in zip(["", None, *t], [None, *t], t)), rel=1e-9, abs=1e-6)


def test_automaton_is_a_distribution(docs):
    conf = lm.Orders(head=4096, pairs=64, triples=16, grams=512)
    model = lm.fit(docs, conf)
    by = np.sort(model.count)[::-1][: conf.pairs].astype(float)
    a = lm.build(by, model.two, model.three, model.total, model.d1, conf)
    outside = 1 - ((by - model.d1) / model.total).sum()
    for state in range(len(a.fail)):
        assert sum(10 ** a.traverse([w], state) for w in range(conf.pairs)) + 10 ** a.down[state] * outside == pytest.approx(1)


def test_wavelet_matrix():
    for n in (0, 1, 9, 513, 3000):
        v = np.random.default_rng(n).integers(0, 49408, n)
        v[: n // 2] %= 40
        m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(v).to_bytes())
        assert (m.values() == v).all()
        for s in {*v[:4].tolist(), 3, 70000}:
            assert m.occurrences(s) == np.flatnonzero(v == s).tolist() and m.count(s, n // 3, n // 2) == (v[n // 3 : n // 2] == s).sum()
        if n:
            assert (m.access(np.arange(n)) == v).all()


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer(name))
    t.no_truncation()
    t.no_padding()
    return t


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, sf, texts):
    t, start = library("word_bpe_49k.json"), 0
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op3_wavelet_tokens(spark, sf).collect()}
    for i in sorted(texts):
        ids = t.encode(texts[i], add_special_tokens=False).ids + [1]
        assert got[i] == (start, len(ids), crc(ids))
        start += len(ids)


def test_encoder_on_odd_texts():
    t, own = library("word_bpe_49k.json"), tokens.Encoder(queries.tokenizer("word_bpe_49k.json"))
    given = ["", " ", "a<|endoftext|>b <|startoftext|>", "Ünï  Σς x\x85y\n\n'S it's 12", "q" * 500, "é ́"]
    assert [np.frombuffer(x, np.uint32).tolist() for x in own.encode(given)] == [t.encode(x, add_special_tokens=False).ids for x in given]


def optimum(lengths, size):
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for r in set(rooms):
            if r >= lengths[i]:
                left = list(rooms)
                left[left.index(r)] -= lengths[i]
                place(i + 1, left)
        place(i + 1, [*rooms, size - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best[0]


def test_packing_against_the_optimum():
    rng = np.random.default_rng(0)
    for _ in range(150):
        size = int(rng.choice([7, 10, 16]))
        lengths = rng.integers(1, size + 1, rng.integers(0, 9)).tolist()
        p = packing.plan(collections.Counter(lengths), size)
        assert p.sequences <= optimum(lengths, size) + 1


def test_packing(spark, sf, texts):
    t = library("word_bpe_49k.json")
    out = queries.op6_packing(spark, sf).collect()
    pieces, total = {(r["doc_id"], r["piece"]): r for r in out}, 0
    for i, x in texts.items():
        ids = t.encode(x, add_special_tokens=False).ids + [1]
        total += len(ids)
        for n, lo in enumerate(range(0, len(ids), 4096)):
            r = pieces.pop((i, n))
            assert (r["start"], r["length"], r["ids_crc32"]) == (lo, len(ids[lo : lo + 4096]), crc(ids[lo : lo + 4096]))
    assert not pieces
    by = collections.defaultdict(list)
    for r in out:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) <= math.ceil(total / 4096) + 2


def test_fingerprints(spark, sf, texts):
    got = {r["doc_id"]: r for r in queries.op9_fingerprint(spark, sf).collect()}
    order = sorted(texts, reverse=True)
    for i, j in zip(order, order[1:] + order[:1]):
        x, cut = texts[i], len(texts[i]) // 3
        changed = x[: len(x) - cut] + texts[j][:cut]
        assert got[i]["n_chars"] == len(x) and got[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert got[i]["fingerprint"] == fingerprint.digest(x.encode()) and got[i]["edited_fingerprint"] == fingerprint.digest(changed.encode())
        assert got[i]["near_next"] == fingerprint.likeness([got[i]["fingerprint"]], [got[j]["fingerprint"]])[0]
    assert np.mean([r["near_edited"] > r["near_next"] for r in got.values()]) > 0.95
    assert fingerprint.likeness([fingerprint.digest(b"")], [fingerprint.digest(b"")])[0] == 1


def test_bpe(spark, sf, texts):
    t = library("byte_bpe_50k.json")
    for r in queries.op10_bpe(spark, sf).collect():
        ids = t.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_long_words_and_odd_spaces():
    t, own = library("byte_bpe_50k.json"), bpe.codec(queries.tokenizer("byte_bpe_50k.json"))
    for x in ("ab" * 400, "the" * 700, "  a \n\n b\t", "it's <|endoftext|>x  ", " 　é", "日本語" * 90, "a \x85\x1c b"):
        assert own.encode(x).tolist() == t.encode(x, add_special_tokens=False).ids and own.decode(own.encode(x)) == x


def test_url_rules(spark):
    urls = ["http://a.b.NET/x", "https://www.example.net/en/1?x", "http://example.com/de/", "http://notexample.com/de/", "http://example.com/dex", "ftp://q.org/fr/a#b", "http://x.net", "no scheme", None, "http://HOST?x=http://y.net/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    labels = spark.createDataFrame([], "page_id bigint, label string")
    got = [(r["host"], r["path"], r["rule"]) for r in urlfilter.judge(pages, labels).orderBy("page_id").collect()]
    assert got == [("a.b.net", "/x", "net/"), ("www.example.net", "/en/1", "example.net/en/"), ("example.com", "/de/", "example.com/de/"), ("notexample.com", "/de/", None), ("example.com", "/dex", None), ("q.org", "/fr/a", "org/fr/"), ("x.net", "", None), ("", "", None), ("", "", None), ("host", "", None)]


def test_url_mining_against_brute_force(spark):
    rng = np.random.default_rng(4)
    made = [(i, f"http://{rng.choice(['spam', 'good', 'mid'])}.x{rng.integers(3)}.com/{rng.choice(['a', 'b'])}/p{i}") for i in range(300)]
    labels = [(i, "block" if "spam" in u and "/b/" in u else "allow") for i, u in made if i < 200]
    conf = urlfilter.Mining(support=0.02, confidence=0.9)
    pages = spark.createDataFrame(made, "page_id bigint, url string")
    out = {r["page_id"]: r["verdict"] for r in urlfilter.judge(pages, spark.createDataFrame(labels, "page_id bigint, label string"), conf).collect()}
    assert all(out[i] == ("block" if "spam" in u and "/b/" in u else "allow") for i, u in made)


def test_pipeline_stages(spark, sf, docs):
    import corpus_pipeline as p

    now, columns = docs, docs.columns
    counts = [docs.count()]
    for name, stage in p.STAGES:
        out = shared.stored(stage(spark, now, sf), name)
        if name != p.STAGES[-1][0]:
            assert out.columns == columns
        if name == "near_dedup":
            left = {r["doc_id"]: r["text"] or "" for r in now.collect()}
            assert {r["doc_id"] for r in out.collect()} == {i for i, (_, c) in brute_classes({i: t.translate(str.maketrans(urlfilter.UPPER, urlfilter.LOWER)) for i, t in left.items()}, 5, 80).items() if i == c}
        counts.append(out.count())
        now = out
    assert counts[0] >= counts[1] >= counts[2] == counts[3] >= counts[4] > 0
    assert now.select("doc_id").distinct().count() == counts[4]


def brute_rows(rows, k=5):
    """Indexes of the rows that near-dedup keeps; of equal rows the first."""
    sets = []
    for _, t in rows:
        w = words((t or "").translate(str.maketrans(urlfilter.UPPER, urlfilter.LOWER)))
        sets.append(set(zip(*[w[j:] for j in range(k)])) if len(w) >= k else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[i] if g == group[j] else g for g in group]
    kept = []
    for g in sorted(set(group)):
        own = [i for i in range(len(rows)) if group[i] == g]
        kept.append(own[0] if not sets[own[0]] else min(own, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)))
    return kept


CLASHING = ("_gone", "_row", "_run_of", "removed", "row", "rid", "fold", "kept", "score", "_id", "component", "range", "places", "h")


def test_near_dedup_goes_by_row(spark, sf):
    import corpus_pipeline as p

    rng = np.random.default_rng(3)
    a, b, c, z = (" ".join(f"{x}{n}" for n in rng.integers(0, 10**6, 60)) for x in "abcz")
    near = c + " one"
    rows = [(2, b), (5, a), (5, b), (None, c), (None, c + ""), (9, near), (7, z), (7, z), (None, None), (1, None), (1, None), (3, " \n"), (None, "x y")]
    frame = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA).select("*", *[F.lit(n).alias(x) for n, x in enumerate(CLASHING)])
    got = p.near_dedup(spark, frame, sf)
    assert got.columns == frame.columns
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(key, got.select("doc_id", "text").collect())) == sorted(key(rows[i]) for i in brute_rows(rows))
    assert all(tuple(r[x] for x in CLASHING) == tuple(range(len(CLASHING))) for r in got.collect())
    assert p.near_dedup(spark, frame.limit(0), sf).count() == 0


def test_one_row_of_repeated_rows_with_other_columns(spark, sf):
    import corpus_pipeline as p

    frame = spark.createDataFrame([(7, "a b c d e f", x, "s", 1) for x in ("en", "de", "de", "fr")] + [(8, "a b c d e f", "aa", "s", 1)], SCHEMA)
    assert [tuple(r) for r in p.near_dedup(spark, frame, sf).collect()] == [(7, "a b c d e f", "de", "s", 1)]


def test_stages_carry_clashing_columns(spark, sf, docs):
    import corpus_pipeline as p

    now = docs.select("*", *[F.concat(F.lit(x), F.col("doc_id").cast("string")).alias(x) for x in CLASHING])
    for name, stage in p.STAGES:
        out = shared.stored(stage(spark, now, sf), name)
        if name != p.STAGES[-1][0]:
            assert out.columns == now.columns
            assert out.filter(" or ".join(f"`{x}` <> concat('{x}', doc_id)" for x in CLASHING)).count() == 0
        now = out
    assert now.count() > 0


def test_positions_are_few_and_hot_passages_are_combined(spark, docs, texts):
    base = docs.select(F.xxhash64("doc_id").alias("rid"), F.col("doc_id").alias("ord"), "text")
    run = linededup._positions(linededup.words_of, linededup.Runs(), False)
    rows = base.coalesce(1).mapInArrow(run, linededup._ROWS)
    windows = sum(max(0, len(words(t)) - 49) for t in texts.values())
    assert rows.filter("not later").count() < windows / 8
    passage = " ".join(f"p{i}" for i in range(80))
    hot = table(spark, [(i, f"{passage} end{i}") for i in range(300)]).select(F.xxhash64("doc_id").alias("rid"), F.col("doc_id").alias("ord"), "text").coalesce(1)
    got = hot.mapInArrow(run, linededup._ROWS).filter("not later").groupBy("h").count()
    assert got.agg(F.max("count")).first()[0] == 1


@pytest.mark.parametrize("vocabulary", [2, 4, 40])
def test_line_dedup_of_periodic_texts(spark, vocabulary):
    """Runs that overlap themselves, equal ids, null ids and repeated rows, against brute force."""
    rng = np.random.default_rng(vocabulary)
    made = []
    for i in range(30):
        unit = [f"u{x}" for x in rng.integers(0, vocabulary, rng.integers(1, 40))]
        made.append((i, " ".join((unit * 200)[: int(rng.integers(30, 260))])))
    for i in range(30, 45):
        a, b = made[int(rng.integers(30))][1].split(), made[int(rng.integers(30))][1].split()
        made.append((i, " ".join([*a[: len(a) // 2], f"x{i}", *b[len(b) // 3 :]])))
    seen, gone = set(), {}
    for i, t in made:
        w = t.split()
        gone[i] = set()
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            gone[i] |= set(range(k, k + 50)) if key in seen else set()
            seen.add(key)
    frame = table(spark, [*made, made[3], made[40]]).repartition(5)
    for r in linededup.dedup_passages(frame).collect():
        assert {k for s in r["removed"] for k in range(s["lo"], s["hi"] + 1)} == gone[r["doc_id"]]


def test_lines_are_removed_exactly(docs, texts):
    brute = brute_dedup(texts.items())
    for r in linededup.dedup(docs).collect():
        worded = {k for k, x in enumerate(brute[r["doc_id"]][0]) if words(x)}
        assert {k for s in r["removed"] for k in range(s["lo"], s["hi"] + 1)} & worded == brute[r["doc_id"]][1]


def test_lookups_on_shard_files(spark, docs, texts, tmp_path):
    where = str(tmp_path / "shards")
    wavelet.write(docs, where, queries.tokenizer("word_bpe_49k.json"))
    t = library("word_bpe_49k.json")
    ids = {i: [*t.encode(texts[i], add_special_tokens=False).ids, 1] for i in sorted(texts)}
    flat = np.concatenate([ids[i] for i in sorted(ids)])
    asked = [1, int(flat[0]), int(flat[777]), 49_000, 1 << 20]
    assert dict(wavelet.counts(spark, where, asked).collect()) == {s: int((flat == s).sum()) for s in asked}
    places = [0, 5, len(flat) // 2, len(flat) - 1, len(flat) + 9]
    assert dict(wavelet.at_positions(spark, where, places).collect()) == {p: int(flat[p]) for p in places[:-1]}
    rare = asked[2]
    got = sorted((r["doc_id"], r["at"]) for r in wavelet.occurrences(spark, where, [rare]).collect())
    assert got == [(i, k) for i in sorted(ids) for k, x in enumerate(ids[i]) if x == rare]


def test_lookups_read_little_of_a_file(tmp_path):
    rng = np.random.default_rng(0)
    v = (rng.zipf(1.3, 3_000_000) % 49_000).astype(np.uint32)
    (tmp_path / "s").write_bytes(wavelet.WaveletMatrix.build(v).to_bytes())
    size = (tmp_path / "s").stat().st_size
    m = wavelet.WaveletMatrix.open(str(tmp_path / "s"))
    assert m.access([123_456, 2_999_999]).tolist() == v[[123_456, 2_999_999]].tolist() and m.touched < size / 10
    m = wavelet.WaveletMatrix.open(str(tmp_path / "s"))
    assert m.count(17) == (v == 17).sum() and m.touched < size / 10
    rare = int(v[1_000_000])
    assert m.occurrences(rare) == np.flatnonzero(v == rare).tolist() and m.select(rare, 0) == int(np.flatnonzero(v == rare)[0])
    assert (m.values() == v).all()
    with pytest.raises(ValueError):
        m.select(rare, 1 << 40)


def test_url_rules_against_brute_force(spark):
    """Every mined rule, with its confidence and support, against all combinations of the tokens."""
    import itertools

    rng = np.random.default_rng(8)
    rows = [(sorted({f"t{x}" for x in rng.integers(0, 7, 4)}), str(rng.choice(["allow", "block"], p=[0.7, 0.3]))) for _ in range(120)]
    rows = [(i, "block" if {"t1", "t2"} <= set(i) else y) for i, y in rows]
    conf = urlfilter.Mining(support=0.05, confidence=0.7)
    want = {}
    for size in range(1, 5):
        for items in itertools.combinations([f"t{x}" for x in range(7)], size):
            hit = [y for i, y in rows if set(items) <= set(i)]
            for label in ("allow", "block"):
                n = hit.count(label)
                if hit and n / len(rows) >= conf.support and n / len(hit) >= conf.confidence and not any(set(o) < set(items) and y == label and c >= n / len(hit) - 1e-12 for (o, y), (c, _) in want.items()):
                    want[items, label] = (n / len(hit), n / len(rows))
    got = {(tuple(r["items"]), r["label"]): (r["confidence"], r["support"]) for r in urlfilter.mine(spark.createDataFrame(rows, "items array<string>, label string"), conf).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def test_labels_that_disagree(spark):
    pages = spark.createDataFrame([(i, f"http://a{i % 2}.com/x") for i in range(40)] + [(0, "http://a1.com/x"), (None, None)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, x) for i in range(0, 40, 2) for x in ("allow", "block")] + [(i, "allow") for i in range(1, 40, 2)], "page_id bigint, label string")
    got = urlfilter.judge(pages, labels.repartition(3)).collect()
    assert {(r["host"], r["verdict"]) for r in got} == {("a0.com", "block"), ("a1.com", "allow"), ("", "allow")} and len(got) == 42


def test_noisy_or_against_brute_force(spark):
    """A document's score: one less the leak's and every sentence's chance to be clean."""
    rng = np.random.default_rng(6)
    made = [(i, ". ".join(" ".join(f"w{x}" for x in rng.integers(0, 60, 6)) for _ in range(5)) + ("! vile" if i % 4 == 0 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in made], "doc_id bigint, toxic int")
    frame = table(spark, [*made, (900, None), (901, "  "), (None, made[0][1]), (902, "vile. " * 400_000)])
    model = toxicity.fit(frame, labels)
    conf = toxicity.Bags()
    import pyarrow as pa

    def bucket(word):
        _, _, data, offsets = next(kernel.blocks(pa.array([word])))
        return int(kernel.Words(data, offsets, lower=True, inside=toxicity._WORD[data]).hash[0] % np.uint64(conf.buckets))

    for r in toxicity.score(frame, model, carry=("doc_id", "text")).collect():
        clean = 1 - model.leak
        sentences = [s for s in re.split(r"[.!?\n]", r["text"] or "") if s] if r["doc_id"] != 902 else ["vile", " vile"]
        for s in sentences:
            z = model.bias + sum(float(model.weight[b]) for b in {bucket(w) for w in re.findall(r"[0-9A-Za-z]+", s)})
            clean *= 1 - min(1 / (1 + math.exp(-max(-30, min(30, z)))), 1 - 1e-6)
        if r["doc_id"] == 902:
            assert r["score"] == 1 and r["n_sentences"] >= 400_000 and len(r["offending"]) >= 400_000
        else:
            assert r["score"] == pytest.approx(1 - clean, abs=1e-9)


def test_quality_ratio_against_brute_force(spark):
    rng = np.random.default_rng(11)
    made = [(i, " ".join(f"w{x}" for x in rng.integers(0, 30 + 30 * (i % 2), 70))) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    conf = quality.Ratio()
    frame = table(spark, made)
    import pyarrow as pa

    def buckets(text):
        _, _, data, offsets = next(kernel.blocks(pa.array([text])))
        return quality.grams(kernel.Words(data, offsets), conf.buckets)[0].tolist()

    fold = {r["doc_id"]: 1 + r["f"] for r in frame.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("f")).collect() if r["doc_id"] < 40 and r["doc_id"] % 2 == 0}
    raw, good = collections.Counter(), {1: collections.Counter(), 2: collections.Counter()}
    for i, t in made:
        raw.update(buckets(t))
        if i in fold:
            good[fold[i]].update(buckets(t))

    def score(text, counts):
        total, every = sum(counts.values()), sum(raw.values())
        own = [math.log((counts[b] + conf.prior) / (raw[b] * total / every + conf.prior)) for b in buckets(text)]
        return sum(own) / max(len(own), 1)

    got = {r["doc_id"]: r for r in quality.judge(frame, labels).collect()}
    assert all(got[i]["score"] == pytest.approx(score(t, good[1] + good[2]), abs=1e-9) for i, t in made)
    known = sorted(math.floor(score(t, good[3 - fold[i]]) / conf.grain) for i, t in made if i in fold and not got[i]["base_failed"])
    least = known[int(conf.spare * len(known))] * conf.grain
    assert all(got[i]["kept"] == (not got[i]["base_failed"] and got[i]["score"] >= least) for i in got)


def test_digest_against_brute_force():
    conf = fingerprint.Digest()

    def brute(data):
        counts = [0] * 256
        padded = data + bytes(4)
        for at in range(len(data)):
            for salt, (i, j, k) in enumerate(fingerprint._TRIPLETS):
                x = padded[at + i] | padded[at + j] << 8 | padded[at + k] << 16
                x = x * 0x9E3779B1 & 0xFFFFFFFF
                x ^= 0x3C6EF372 * (salt + 1) & 0xFFFFFFFF
                x ^= x >> 15
                x = x * 0x85EBCA77 & 0xFFFFFFFF
                counts[x >> 24] += 1
        q = sorted(counts)
        q1, q2, q3 = q[63], q[127], q[191]
        codes = [sum(c > x for x in (q1, q2, q3)) for c in counts]
        length = min(255, math.ceil(math.log(len(data)) / math.log(1.1))) if data else 0
        body = bytes(codes[i] | codes[i + 1] << 2 | codes[i + 2] << 4 | codes[i + 3] << 6 for i in range(0, 256, 4))
        return (bytes([length, (16 * q1 // (q3 + 1) & 15) << 4 | 16 * q2 // (q3 + 1) & 15]) + body).hex(), codes, length

    texts = [b"", b"a", b"the cat sat on the mat " * 30, bytes(range(256)) * 3, "日本語 text".encode() * 50]
    made = [brute(x) for x in texts]
    assert [fingerprint.digest(x, conf) for x in texts] == [m[0] for m in made]
    for a, ca, la in made:
        for b, cb, lb in made:
            ra, rb = int(a[2:4], 16), int(b[2:4], 16)
            apart = sum((0, 1, 2, 6)[abs(x - y)] for x, y in zip(ca, cb)) + min(abs(la - lb), 24) + min(abs((ra >> 4) - (rb >> 4)), 4) + min(abs((ra & 15) - (rb & 15)), 4)
            assert fingerprint.likeness([a], [b])[0] == pytest.approx(max(0, 1 - apart / (conf.far * 256)))


def test_texts_above_a_block(spark, sf, tmp_path):
    """Texts of more than one block, with null and repeated ids: values against the libraries and brute force."""
    rng = np.random.default_rng(2)
    long = " ".join(f"word{x}" for x in rng.integers(0, 4000, 300_000))
    assert len(long) > kernel.BLOCK_BYTES
    rows = [(1, long), (None, long), (1, "a b c"), (1, "a b c"), (2, "x " + long[:400_000]), (None, None)]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op4_minhash_neardup(spark, str(tmp_path)).collect()
    distinct = len(set(zip(long.split(), long.split()[1:])))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got if r["n_shingles"] > 100_000) == [("1", distinct, "1"), ("None", distinct, "1")]
    for r in queries.op7_line_dedup(spark, str(tmp_path)).collect():
        if r["doc_id"] is None and r["text"] is not None:
            assert r["text"] == "" and [tuple(s) for s in r["removed"]] == [(0, 299_999)]
        elif r["doc_id"] == 2:
            assert r["text"].split() == ["x", (r["text"].split() or [""])[-1]]
    byte = library("byte_bpe_50k.json")
    want = hashlib.sha256(",".join(map(str, byte.encode(long, add_special_tokens=False).ids)).encode()).hexdigest()
    assert [r["ids_sha256"] == want for r in queries.op10_bpe(spark, str(tmp_path)).collect() if r["n_tokens"] > 100_000 and r["doc_id"] != 2] == [True, True]
    t = library("word_bpe_49k.json")
    ids = t.encode(long, add_special_tokens=False).ids + [1]
    shards = queries.op3_wavelet_tokens(spark, str(tmp_path)).collect()
    assert [(r["n_tokens"], r["ids_crc32"]) for r in shards if r["n_tokens"] > 200_000 and r["doc_id"] in (1, None)] == [(len(ids), crc(ids))] * 2
    starts = sorted((r["start"], r["n_tokens"]) for r in shards)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    prints = [r for r in queries.op9_fingerprint(spark, str(tmp_path)).collect() if r["n_chars"] == len(long)]
    assert [r["fingerprint"] for r in prints] == [fingerprint.digest(long.encode())] * 2
