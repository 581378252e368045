"""The two vector searches and the tokenizer alignment against brute force: nulls, empty and odd rows, ties, repeats, empty tables,
clashing extra columns."""

import collections
import hashlib
import itertools
import math
import random

import duckdb
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from metrolens.llm import alignment, multi_index, one_bit, queries, vectors
from metrolens.llm.queries import vocabulary

from ..conftest import SF_CHECK, SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, block int, uid string, score double, tag long, data string"


def rows(n=700, d=24, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, d))
    x = centres[rng.integers(0, 12, n)] + 0.4 * rng.standard_normal((n, d))
    x[60:90] = x[60]  # ties
    out = [(int(i), [float(np.float32(c)) for c in v], int(rng.integers(0, 10)), 1, "u", 0.5, 2, "x") for i, v in enumerate(x)]
    out.append(out[200])  # a query twice
    odd = [None, [], [None] + [1.0] * (d - 1), [math.nan] + [1.0] * (d - 1), [math.inf] + [1.0] * (d - 1), [0.0] * d, [1.0, 2.0], out[7][1]]
    return out + [(v, e, 3, 1, "u", 0.5, 2, "x") for v, e in zip([800, 801, 802, 803, 804, 900, 806, None], odd)] + [(1000, out[5][1], None, 1, "u", 0.5, 2, "x")]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def taking_part(zeros):
    keep = []
    for vec_id, e, label, *_ in rows():
        if e and len(e) == 24 and all(c is not None and math.isfinite(c) for c in e) and (zeros or any(e)):
            keep.append((vec_id, np.array(e), label))
    return keep


def nearest_by_hand():
    part = taking_part(False)
    x = np.array([v for _, v, _ in part])
    for at, (vec_id, v, _) in enumerate(part):
        if vec_id is not None and vec_id % 100 == 0:
            d = np.sqrt(((x - v) ** 2).sum(1))
            order = sorted((k for k in range(len(part)) if k != at), key=lambda k: (d[k], part[k][0] is None, part[k][0]))
            yield vec_id, [(float(d[k]), part[k][0]) for k in order[:10]]


def test_multi_index_recall_and_scores(table):
    got = collections.defaultdict(list)
    for r in sorted(multi_index.nearest(table).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    want, hits, total = list(nearest_by_hand()), 0, 0
    assert sorted(got) == sorted({q for q, _ in want})
    assert [r[0] for r in got[200]] == sorted([*range(1, 11)] * 2)  # the repeated row is a query of its own
    x = {i: v for i, v, _ in taking_part(False)}
    for q, near in want:
        hits += len({v for _, v in near} & {v for _, v, _ in got[q]})
        total += 10
        for _, v, score in got[q]:
            assert score == pytest.approx(float(np.sqrt(((x[q] - x[v]) ** 2).sum())), rel=1e-14, abs=1e-14)
    assert hits / total >= 0.9


@pytest.mark.parametrize("n", [1, 2, 6])
def test_multi_index_gives_all_of_a_small_table(spark, n):
    t = spark.createDataFrame([(100 * i, [float(i), 0.5]) for i in range(n)], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in multi_index.nearest(t).collect())
    assert got == sorted((100 * a, k + 1, 100 * b, float(abs(a - b))) for a in range(n)
                         for k, b in enumerate(sorted((b for b in range(n) if b != a), key=lambda b: (abs(a - b), b))))


def test_multi_index_recall_on_the_given_table(spark):
    t = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    p = t.toPandas()
    x = np.array(p.embedding.tolist(), float)
    got = {(r.query_id, r.vec_id) for r in multi_index.nearest(t).collect()}
    hits = 0
    for at in np.flatnonzero(p.vec_id % 100 == 0):
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        d[at] = np.inf
        hits += sum((p.vec_id[at], p.vec_id[k]) in got for k in np.lexsort((p.vec_id, d))[:10])
    assert hits >= 0.9 * 10 * (p.vec_id % 100 == 0).sum()


def test_pairs_are_traversed_in_order_of_distance():
    rng = np.random.default_rng(0)
    books = multi_index.Codebooks(rng.standard_normal((7, 3)), rng.standard_normal((5, 4)))
    q = rng.standard_normal(7)
    d = (multi_index.squared(q[None, :3], books.centres[0]).T + multi_index.squared(q[None, 3:], books.centres[1])).ravel()
    order = list(books.traverse(q))
    assert sorted(order) == list(range(35))
    assert np.allclose(d[order], np.sort(d))


def test_hot_cell_is_dealt_to_several_blocks():
    placed = multi_index.place_cells({0: 5, 1: 900, 2: 40, 3: 55}, 10)
    used = [b for first, n in placed.values() for b in range(first, first + n)]
    assert placed[1][1] == 9 and not set(range(placed[1][0], placed[1][0] + 9)) & {placed[0][0], placed[2][0], placed[3][0]}
    assert max(used) < 20


def negatives_by_hand(given):
    part = []
    for at, (vec_id, e, label, *_) in enumerate(given):
        if e and len(e) == 24 and all(c is not None and math.isfinite(c) for c in e) and label is not None:
            label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
            part.append((vec_id, np.floor(256 * np.array(e)).astype(np.int64), label))
    last = lambda v: (v is None, v)
    out = []
    for at, (a, v, label) in enumerate(part):
        if a is None or a % 100:
            continue
        score = [int(v @ w) for _, w, _ in part]
        same = sorted((k for k in range(len(part)) if k != at and part[k][2] == label), key=lambda k: (-score[k], last(part[k][0])))[:5]
        for p in same:
            near = sorted((k for k in range(len(part)) if part[k][2] != label and 30 * score[p] <= 100 * score[k] <= 90 * score[p]),
                          key=lambda k: (-score[k], last(part[k][0])))[:10]
            out += [(a, part[p][0], i + 1, part[k][0], score[p], score[k]) for i, k in enumerate(near)]
    return out


def in_order(found):
    return sorted(found, key=repr)


def test_negatives_equal_brute_force(table):
    assert in_order(tuple(r) for r in one_bit.hard_negatives(table).collect()) == in_order(negatives_by_hand(rows()))


def test_intervals_hold_every_score_and_rule_rows_out():
    rng = np.random.default_rng(5)
    for d in (1, 3, 64, 100):
        v = one_bit.integers(rng.standard_normal((400, d)))
        v[0] = 0
        turn = one_bit.rotation(d)
        codes = one_bit.Codes(v.astype(float), turn)
        for a in v[:20]:
            estimate, width = codes.interval(turn @ a)
            assert (np.abs(estimate - v @ a) <= width).all()
        if d == 64:
            assert np.mean(estimate + width < 0.3 * (a @ a)) > 0.3


def test_large_components_saturate(spark):
    t = spark.createDataFrame([(100, [1e300, 1.0], 1), (101, [1e300, -1e300], 1), (102, [1e300, 0.0], 2)], "vec_id long, embedding array<double>, label int")
    assert one_bit.hard_negatives(t).count() >= 0


@pytest.mark.parametrize("run", [multi_index.nearest, one_bit.hard_negatives])
def test_empty_tables(none, run):
    assert run(none).collect() == []


def test_negatives_match_their_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF_CHECK}/embeddings.parquet')")
    want = con.execute(queries.SQL["op13_one_bit_negatives"]).fetchall()
    assert in_order(tuple(r) for r in queries.QUERIES["op13_one_bit_negatives"](spark, SF_CHECK).collect()) == in_order(want)


def test_blocks_grow_with_the_root_and_stay_bounded():
    assert [vectors.block_count(n) for n in (0, 1, 10_000, 51_282)] == [1, 1, 13, 29]
    n = 400_000_000_000
    assert n / vectors.block_count(n) <= vectors.BLOCK_ROWS


A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = [None, "", " ", "a▁b", "<|endoftext|> x <s> it's </s> <unk> <0x41>", "naïve 日本 \U0001f600  tab\t\n", "don't " * 700, "x" * 3000, "\x00\x1c a b", "Жизнь  тут",
       "ＡＢ ½ é ﬁ", "line\n\n  two \r\n", "one"]


class ByHand:
    def __init__(self):
        self.tok = Tokenizer.from_file(vocabulary(A))
        self.tok.encode_special_tokens = True
        self.sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(B))
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in visible]
        letter = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.name = {i: bytes(letter[c] for c in n) for n, i in self.tok.get_vocab().items() if n != "<|endoftext|>"}

    def b_name(self, i):
        p = self.sp.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(self, text):
        """A ids, B ids and the byte ranges of both; None without tokens."""
        if not text:
            return None
        a, b = self.tok.encode(" " + text, add_special_tokens=False).ids, self.sp.encode(text)
        an, bn = [self.name[i] for i in a], [self.b_name(i) for i in b]
        if not b"".join(an) == b"".join(bn) == (" " + text).encode():
            return None
        ends = [list(itertools.accumulate(map(len, n))) for n in (an, bn)]
        return a, b, *[list(zip([0, *e], e)) for e in ends]

    def rows(self, texts):
        found = []
        for text in texts:
            got = self.tokens(text)
            if got is None:
                found.append(None)
                continue
            a, b, ra, rb = got
            links = [(i, j) for i, (x, y) in enumerate(ra) for j in range(max(0, i - 60) if len(b) < 200 else 0, len(b)) if rb[j][0] < y and x < rb[j][1]]
            groups, i, j = [], 0, 0
            for e in sorted({y for _, y in ra} & {y for _, y in rb}):
                i2, j2 = i, j
                while i2 < len(a) and ra[i2][1] <= e:
                    i2 += 1
                while j2 < len(b) and rb[j2][1] <= e:
                    j2 += 1
                groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
                i, j = i2, j2
            found.append((len(a), len(b), len(groups), [(a[i], b[j]) for i, j in links], hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
        count = collections.Counter(p for f in found if f for p in set(f[3]))
        most = collections.defaultdict(int)
        for (a, _), n in count.items():
            most[a] = max(most[a], n)
        return [(0, 0, 0, 0, 0, 0, "") if f is None else
                (f[0], f[1], f[2], len(f[3]), sum(count[p] == most[p[0]] for p in f[3]), sum(count[p] for p in f[3]), f[4]) for f in found], found


@pytest.fixture(scope="module")
def by_hand():
    return ByHand()


def some_texts(spark):
    rng = random.Random(2)
    given = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect() if r.text and len(r.text) < 1500][:60]
    noise = ["".join(rng.choice("ab'Z é.\n 1×\tß▁ж") for _ in range(rng.randint(1, 40))) for _ in range(80)]
    return ODD + given + noise


def test_alignment_equals_brute_force(spark, by_hand, monkeypatch):
    texts = some_texts(spark)
    docs = spark.createDataFrame([(None if k == 3 else k // 2, t, 1, "x", 2) for k, t in enumerate(texts)],
                                 "doc_id long, text string, n_a int, chunk string, pair int").repartition(3)
    want, found = by_hand.rows(texts)
    order = lambda found: sorted(found, key=repr)
    got = alignment.aligned_counts(docs, vocabulary(A), vocabulary(B)).collect()
    assert order(tuple(r) for r in got) == order((None if k == 3 else k // 2, *w) for k, w in enumerate(want))
    for r in alignment.align(docs, vocabulary(A), vocabulary(B)).filter("doc_id is not null").collect():
        assert [(i, j) for i, j in zip(r.link_a, r.link_b)] in [f[5] if f else [] for k, f in enumerate(found) if k // 2 == r.doc_id]
        assert len(r.cut_a) == len(r.cut_b) in [w[2] for k, w in enumerate(want) if k // 2 == r.doc_id]


def test_fast_ids_equal_the_libraries(by_hand):
    rng = random.Random(4)
    spell = alignment.spelling(vocabulary(A), vocabulary(B))
    assert spell.a.ranks is not None and spell.by_word
    texts = ["".join(rng.choice(" \t\n\r\x0b'sSdtl19é.ÿ,!aB") for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    for text, a, b in zip(texts, spell.a_ids(texts), spell.b_ids(texts)):
        assert a.tolist() == by_hand.tok.encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert b.tolist() == by_hand.sp.encode(text), repr(text)


def test_alignment_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.aligned_counts(docs, vocabulary(A), vocabulary(B)).collect() == []
    assert alignment.align(docs, vocabulary(A), vocabulary(B)).collect() == []
