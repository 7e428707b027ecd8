"""Neighbour search, filter audit and tokenizer alignment against brute force, on awkward rows."""

import collections
import glob
import hashlib
import itertools
import random
import re
import tracemalloc
import types

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pyspark
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_operators import CLASHES, PASSAGE, ROWS, frame, same

from tokenizers import Tokenizer

from precinct.llm import alignment, audit, hashing
from precinct.llm.queries import BYTE_LEVEL, PIECES, QUERIES

SF = "/root/testdata/sf0.01"


# --- neighbours


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def nearest(rows, every, k):
    """(query id, [(score, id)]) of each usable query row, by exact cosine; rows are told apart by their place."""
    rows = [(i, v) for i, v in rows if i is not None and usable(v)]
    wide = max((len(v) for _, v in rows), default=1)
    m = np.array([list(v) + [0.0] * (wide - len(v)) for _, v in rows], float).reshape(-1, wide)
    m /= np.abs(m).max(1, keepdims=True)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    out = []
    for at, (q, _) in enumerate(rows):
        if q % every == 0:
            scores = m @ m[at]
            best = sorted((round(-s, 9), i) for n, (s, (i, _)) in enumerate(zip(scores, rows)) if n != at)[:k]
            out.append((q, [(i, -s) for s, i in best]))
    return out


def answers(got):
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank, r.vec_id)):
        by[r.query_id, r.rank].append((r.vec_id, round(r.score, 9)))
    return by


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return df.select("*", *[F.lit(1).alias(c) for c in ("v", "kx", "ids", "block", "data", "copies", "best", "place", "query_id", "rank", "score")])


IS_QUERY = "vec_id % 50 = 0"


def test_neighbours_of_awkward_rows(spark):
    # few rows: the whole of the codes lies within the radius, and results are exact
    r = random.Random(1)
    rows = [(i, [r.choice([0.0, -1.5, 0.3, 2.0, 0.01]) for _ in range(r.choice([3, 8]))] + [1.0]) for i in range(1, 140)]
    rows += [(200, None), (250, [1.0, None]), (300, [float("nan"), 1.0]), (350, [float("inf")]), (None, [1.0]), (400, []), (450, [0.0, -0.0])]
    rows += [(500, [1e300, -1e300]), (501, [3e-300, -3e-300]), (502, [1.0, -1.0])]  # one direction, whatever the length
    rows += [(550, [7.0, 1.0])] + [(600 + i, [7.0, 1.0]) for i in range(1, 30)]  # more copies than answers
    rows += [(50, [0.5, 0.5, 0.1]), (50, [0.5, 0.5, 0.1]), (50, [-4.0, 1.0]), (13, [0.5, 0.5, 0.1])]  # an id of several rows, two of them equal
    got = hashing.search(spark, vectors(spark, rows), F.expr(IS_QUERY), confidence=1.0, block=40, queries=3).collect()
    want = collections.defaultdict(list)
    for q, best in nearest(rows, 50, 5):
        for k, (i, s) in enumerate(best):
            want[q, k + 1].append((i, round(s, 9)))
    assert {q: sorted(x) for q, x in answers(got).items()} == {q: sorted(x) for q, x in want.items()}
    assert {r.query_id for r in got} == {50, 100, 500, 550} and [(r.vec_id, r.score) for r in got if r.query_id == 550] == [(601 + i, 1.0) for i in range(5)]


def test_neighbours_of_nothing(spark):
    assert hashing.search(spark, vectors(spark, []), F.expr(IS_QUERY)).count() == 0
    assert hashing.search(spark, vectors(spark, [(50, [1.0])]), F.expr(IS_QUERY)).count() == 0
    assert [tuple(r) for r in hashing.search(spark, vectors(spark, [(50, [1.0]), (7, [2.0])]), F.expr(IS_QUERY)).collect()] == [(50, 1, 7, 1.0)]
    assert hashing.search(spark, vectors(spark, [(51, [1.0]), (7, [2.0])]), F.expr(IS_QUERY)).count() == 0


def test_probes_meet_every_code_of_a_radius():
    r = np.random.default_rng(1)
    v = hashing.scaled(r.normal(size=(3000, 24)))
    codes = hashing.fit(v, 5)
    keys = np.stack([np.arange(3000), np.arange(3000)], 1)
    index = hashing.Index({"keys": keys.tobytes(), "v": v.tobytes(), "ids": np.arange(3000).tobytes(), "starts": np.arange(3001).tobytes()}, 24, codes)
    for code in index.codes[:5].tolist():
        far, met = np.bitwise_count(index.codes ^ np.uint64(code)), []
        for radius, entries in index.probes(code):
            met += entries.tolist()
            assert set(met) == set(np.flatnonzero(far <= radius).tolist()) and len(met) == len(set(met))
        assert len(met) == 3000


def test_learned_codes_lie_closer_than_random_ones():
    r = np.random.default_rng(2)
    v = r.normal(size=(2000, 64)) * np.linspace(3, 0.2, 64)
    codes, u = hashing.fit(v, 5), v / np.linalg.norm(v, axis=1, keepdims=True)
    loss = lambda m: np.abs(np.abs(u @ m) - 1 / 8).mean()
    assert loss(codes.rotation) < loss(np.linalg.qr(r.normal(size=(64, 64)))[0])


@pytest.mark.parametrize("block", [hashing.BLOCK, 150])
def test_recall(spark, block):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    got = answers(hashing.search(spark, e, F.expr(IS_QUERY), block=block).collect())
    want = nearest(rows, 50, 5)
    hits = sum((i, s) in [(x, pytest.approx(y, abs=1e-9)) for n in range(1, 6) for x, y in got[q, n]] for q, best in want for i, s in best)
    assert hits >= 0.95 * sum(len(b) for _, b in want)


def test_near_copies_of_a_hot_vector_are_found(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=32)
    rows = [(i, (base + 0.01 * r.normal(size=32)).tolist() if i % 3 == 0 else r.normal(size=32).tolist()) for i in range(3000)]
    got = answers(hashing.search(spark, vectors(spark, rows), F.expr(IS_QUERY), block=700).collect())
    want = nearest(rows, 50, 5)
    hits = sum(any(i == x for n in range(1, 6) for x, _ in got[q, n]) for q, best in want for i, _ in best)
    assert hits >= 0.9 * 5 * len(want)


# --- audit


def failed(rows):
    """Letters of the filters that each row fails."""
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    for d, t, _ in rows:
        t = t or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        bad = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), bool(set(t) & set("#$%&*|")), d is not None and d > least[t])
        yield "".join(f for f, b in zip("ABCDE", bad) if b)


def audited(rows, labels):
    good, toxic = ({d for d, *x in labels if d is not None and x[k] == 1} for k in (0, 1))
    out, fails = [], list(failed(rows))
    for part in {p or "" for *_, p in rows}:
        mine = [(d, f) for (d, _, p), f in zip(rows, fails) if (p or "") == part]
        plays, shapley = [], collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                plays.append((f, (part, "".join(order), step, len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == f for x in mine),
                                  sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone))))
        out += [(*r, shapley[f]) for f, r in plays]
    return out


def parts(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    return df.select("*", *[F.lit(7).alias(c) for c in ("id", "part", "digest", "mask", "good", "toxic", "n", "first", "low", "labelled", "quality", "step")])


def test_audit(spark):
    r = random.Random(2)
    rows = [(d, t, r.choice(["en", "de", None, ""])) for d, t in ROWS]
    words = [f"w{i}" for i in range(400)]
    for i in range(80):
        t = " ".join(r.choices(words[: r.choice([3, 90, 400])], k=r.choice([150, 199, 200, 260]))) + r.choice(["", "", " #", " |x", " ABCDEFGHIJKLMNOPQRSTUVWXYZABCDEFGHIJ"])
        rows += [(1000 + 2 * i, t, "en")] * r.choice([1, 1, 2]) + [(1000 + i, t, r.choice(["en", "fr"]))] * r.choice([0, 1])
    rows += [(None, words[0], "en"), (None, words[0], "en"), (5000, words[0], "en")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 1200, 2)] + [(1000, 1, 0), (1000, 0, 1), (None, 1, 1), (9_999_999, 1, 1)]
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1))
    same(audit.audit(parts(spark, rows), told).collect(), audited(rows, labels))


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert audit.audit(parts(spark, []), labels).count() == 0
    got = audit.audit(parts(spark, [(1, "x #", "en"), (2, None, None)]), labels.limit(0)).collect()
    same(got, audited([(1, "x #", "en"), (2, None, None)], []))


def test_potential_is_shapley(spark):
    """Against the average over all orders of a game of random masks."""
    r = random.Random(3)
    counts = [("p", m, r.randint(0, 50), 0, 0) for m in range(32)]
    (g,) = audit.games(spark.createDataFrame(counts, "part string, mask int, n long, good long, toxic long")).collect()
    v = [sum(n for _, m, n, *_ in counts if m & s) for s in range(32)]
    for i in range(5):
        orders = 0
        for order in itertools.permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            orders += v[before | 1 << i] - v[before]
        assert g.p[31] - g.p[31 ^ 1 << i] == orders


def test_audit_shuffles_no_texts(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    plan = audit.audit(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for line in plan.splitlines():
        if "Join" in line or "Window" in line:
            assert "text" not in line


# --- alignment


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Vocabularies.load(BYTE_LEVEL, PIECES)


def whole():
    """Both vocabularies as their own libraries read them."""
    first, second = Tokenizer.from_file(BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    first.encode_special_tokens = True
    return first, second


def plainly(vocabularies, rows):
    """The contract by shared byte offsets of whole texts, with neither units, windows nor chunks."""
    (first, second), (*_, ab, bb) = whole(), vocabularies.ready()
    docs = []
    for d, t in rows:
        want = b" " + (t or "").encode()
        a, b = (first.encode(" " + t, add_special_tokens=False).ids, second.encode(t)) if t else ([], [])
        if not t or b"".join(ab[i] for i in a) != want or b"".join(bb[i] for i in b) != want:
            docs.append((d, [], [], []))
            continue
        ea, eb = (list(itertools.accumulate(len(x[i]) for i in y)) for x, y in ((ab, a), (bb, b)))
        groups, i, j = [], 0, 0
        for cut in sorted(set(ea) & set(eb)):
            i1, j1 = ea.index(cut, i) + 1, eb.index(cut, j) + 1
            groups.append((a[i:i1], b[j:j1]))
            i, j = i1, j1
        docs.append((d, a, b, groups))
    links = [collections.Counter(p for g in groups for p in itertools.product(*g)) for *_, groups in docs]
    held, best = collections.Counter(p for x in links for p in x), collections.defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    for (d, a, b, groups), x in zip(docs, links):
        listed = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        yield (d, len(a), len(b), len(groups), sum(x.values()), sum(n for p, n in x.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in x.items()),
               hashlib.sha256(listed.encode()).hexdigest() if a else "")


def odd_texts():
    r = random.Random(4)
    some = ["a", "é", "漢字", "😀", " ", "  ", "\n", "\t", "\x00", "▁", "<0x41>", "<s>", "<|endoftext|>", "’s", "12345", "́", "ﬁ", "İ", "x" * 30, "the", " end", " ", "ab"]
    return ["".join(r.choice(some) for _ in range(r.randint(1, 25))) for _ in range(150)]


@pytest.mark.parametrize("chunk", [alignment.CHUNK, 3000])
def test_alignment(spark, vocabularies, chunk):
    rows = ROWS + [(2000 + i, t) for i, t in enumerate(odd_texts())] + [(3000, PASSAGE)] * 3
    want = list(plainly(vocabularies, rows))
    same(alignment.aligned(spark, frame(spark, rows).withColumnsRenamed({c: c.upper() for c in CLASHES}), vocabularies, chunk).collect(), want)
    assert sum(w[1] == 0 for w in want) > 5 and max(w[1] for w in want) > 10_000


def test_alignment_of_nothing(spark, vocabularies):
    assert alignment.aligned(spark, frame(spark, []), vocabularies).count() == 0
    got = [tuple(r) for r in alignment.aligned(spark, frame(spark, [(None, None), (1, "")]), vocabularies).collect()]
    same(got, [(None, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")])


def test_units_give_the_tokens_of_the_whole(vocabularies):
    r, texts = random.Random(5), [t for _, t in ROWS if t and len(t) < 5000] + odd_texts()
    texts += [" ".join(r.sample(texts, 4)) for _ in range(60)]
    (first, second), (a, b, *_) = whole(), vocabularies.ready()
    split = [alignment.units(t) for t in texts]
    assert [" ".join(u) for u in split] == texts and max(map(len, split)) > 50
    assert [[i for u in x for i in a.encode_ordinary(" " + u)] for x in split] == [first.encode(" " + t, add_special_tokens=False).ids for t in texts]
    # a text that holds the mark itself is not covered, however it is encoded
    assert all([i for u in x for i in b.encode(u)] == second.encode(t) for x, t in zip(split, texts) if "▁" not in t)


def test_windows_are_remembered(vocabularies, monkeypatch):
    done, memory = [], alignment.Memory(vocabularies.ready())
    real = memory._aligned
    monkeypatch.setattr(memory, "_aligned", lambda a, b: done.extend(a) or real(a, b))
    chunk = alignment.Chunk(memory)
    chunk.add([1], ["blorfent wazzle " * 500])
    assert len(done) <= 4 and len(chunk.units) == len(done)
    chunk.clear()
    chunk.add([1], ["wazzle blorfent"])
    assert len(done) <= 4 and len(chunk.units) == 2
    monkeypatch.setattr(alignment, "KEPT", 1)
    chunk.clear()
    chunk.add([1], ["another one"])
    assert set(memory.windows) == {"another", "one"}


def test_windows_met_again_are_not_encoded_again(vocabularies, monkeypatch):
    done, memory = [], alignment.Memory(vocabularies.ready())
    real = memory._aligned
    monkeypatch.setattr(memory, "_aligned", lambda a, b: done.extend(a) or real(a, b))
    monkeypatch.setattr(alignment, "KEPT", 2)
    chunk = alignment.Chunk(memory)
    for k in range(9):
        chunk.add([k], [f"blorfent {k} wazzle {-k} blorfent"])
        chunk.clear()
    # two words and each turn's own, though the memory was full after every turn
    assert len(done) == 2 + 9 + 8 and len(memory.windows) + len(memory.older) <= 8


def test_large_groups_are_counted(spark, vocabularies, monkeypatch):
    monkeypatch.setattr(alignment, "LARGE", 1)
    chunk = alignment.Chunk(alignment.Memory(vocabularies.ready()))
    rows = [(i, t) for i, t in enumerate(odd_texts() + ["blorfent wazzle blorfent 😀😀 12345"])]
    chunk.add(*map(list, zip(*rows)))
    got = chunk.row(0).to_pylist()[0]
    monkeypatch.setattr(alignment, "LARGE", 1 << 12)
    other = alignment.Chunk(alignment.Memory(vocabularies.ready()))
    other.add(*map(list, zip(*rows)))
    assert got == other.row(0).to_pylist()[0] and any(x > 1 for x in got["often"])


def test_pairs_are_counted_in_portions(vocabularies):
    r = random.Random(6)
    words = ["".join(r.choices("abcdefghij", k=r.randint(2, 9))) for _ in range(4000)]
    texts = [" ".join(r.choices(words, k=300)) for _ in range(1500)]
    chunk, rows = alignment.Chunk(alignment.Memory(vocabularies.ready())), list(enumerate(texts))
    chunk.add(*map(list, zip(*rows)))
    tracemalloc.start()
    row = chunk.row(0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = row.to_pylist()[0]
    assert sum(got["n_links"]) > 1 << 20 and peak < 40 * sum(got["n_links"])
    # as if each document were a chunk
    for k in (0, 700, 1499):
        chunk.clear()
        chunk.add([k], [texts[k]])
        one = chunk.row(0).to_pylist()[0]
        own = slice(got["starts"][k], got["starts"][k + 1])
        assert [(got["keys"][p], n) for p, n in zip(got["pair"][own], got["often"][own])] == [(one["keys"][p], n) for p, n in zip(one["pair"], one["often"])]
        assert all(got[c][k] == one[c][0] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"))


def test_few_units_are_encoded_together(vocabularies, monkeypatch):
    done, memory = [], alignment.Memory(vocabularies.ready())
    real = memory._aligned
    monkeypatch.setattr(memory, "_aligned", lambda a, b: done.append(len(a)) or real(a, b))
    monkeypatch.setattr(alignment, "TOGETHER", 7)
    alignment.Chunk(memory).add([1], [" ".join(f"blorfent{k}" for k in range(30))])
    assert sum(done) == 30 and max(done) <= 7


def test_a_chunk_is_a_row_group(spark, vocabularies, monkeypatch):
    paths, real = [], alignment.Scratch.write

    def write(self, *args):
        out = real(self, *args)
        paths.append(self.paths["chunks"][0])
        return out

    monkeypatch.setattr(alignment.Scratch, "write", write)
    rows = [(k, f"blorfent {k} wazzle {-k} " * 9) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert alignment.aligned(spark, docs, vocabularies, 100).count() == 90
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{paths[0].removeprefix('file:')}/*.parquet")]
    assert sum(f.num_rows for f in files) > 10 and all(f.num_row_groups == f.num_rows for f in files if f.num_rows)


def test_encoders_go_with_their_task(vocabularies, monkeypatch):
    class Docs(dict):
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    sent = alignment.Vocabularies(vocabularies.byte_level, vocabularies.pieces)
    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: types.SimpleNamespace(partitionId=lambda: 3)))
    column = types.SimpleNamespace(cast=lambda _: types.SimpleNamespace(alias=lambda _: None))
    run = alignment._chunks(Docs(doc_id=column, text=column), sent, alignment.CHUNK)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["blorfent wazzle", None]})
    assert [b.to_pylist()[0]["chunk"] for b in run([batch])] == [3 << 32] and sent._ready is None


@pytest.mark.parametrize("name", ["op11_neighbours", "op12_audit", "op13_alignment"])
def test_registered(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
