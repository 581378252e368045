"""The training-data operators against brute force on small fixtures: nulls, empty and long texts, ties, repeated rows,
empty tables, clashing extra columns."""

import collections
import hashlib
import html
import pathlib
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from metrolens.llm import (chunk_dedup, cws, fuzzy_lines, main_text, minmax, mixing, packing, records, tokens, toxicity,
                           url_reputation)
from metrolens.llm.queries import vocabulary
from metrolens.session import checkpoint_root, scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, TARGET long"
PAGES = "page_id long, url string, html string, host string, verdict string"


def syllables(rng, n):
    return " ".join("".join(rng.choice(["th", "an", "er", "in", "on", "re", "ed", "ou"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus():
    rng = random.Random(5)
    base = syllables(rng, 120)
    near = base.split()
    near[7] = "changed"
    texts = [None, "", " \t\n", base, base, base.replace(" ", "  "), " ".join(near), "It's 12 o'clock, naïve Ωμέγα! x", "one",
             "one two", syllables(rng, 30), "Line a b c\n" + syllables(rng, 9) + "\nLine a b c", "line A, b: c!\nother words here",
             "a" * 9000, syllables(rng, 5000), "the the the the", "Жизнь тут  中文"]
    rows = [(i, t, "en", ["s1", "s2", None, "s3"][i % 4], len(t or ""), "x", "y", 1) for i, t in enumerate(texts)]
    return rows + [rows[3], (None, "no name", "en", "s1", 7, "x", "y", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    path = scratch_path(spark, "llm-docs")
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(name):
    plain = Tokenizer.from_file(vocabulary(name))
    plain.encode_special_tokens = True
    own = tokens.TextEncoder(vocabulary(name), memo_pieces=50)
    rng = random.Random(1)
    odd = ["", " ", "\n", "a\n\nb", " a b ", "x\ty", "it's", "a'b 12.5 %%%", "<|endoftext|> a", "ÀÉß×÷µ", "é a", "a \n b", "A b", "İI ΣΑΣ"]
    for text in [r[1] or "" for r in corpus()] + odd + ["".join(rng.choice("ab'Z é.\n 1×\t") for _ in range(30)) for _ in range(300)]:
        assert own.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_special_tokens_in_texts_get_their_ids(name):
    plain, own = Tokenizer.from_file(vocabulary(name)), tokens.encoder(vocabulary(name))
    marks = [t.content for t in plain.get_added_tokens_decoder().values()]
    texts = [t.format(m) for m in marks for t in ("a {} b", "{}", "a{0}{0}b\n", "it's {}", " {} ", "x {} Ω")]
    texts += [t.upper() for t in texts] + [t.replace("|", "| ") for t in texts] + ["a <|endoftext| > b"]
    assert marks
    for text in texts:
        assert own.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
    assert own.ids("a b " + marks[0])[-1] == plain.token_to_id(marks[0])


def test_records_round_trip(spark, docs, none):
    folder = scratch_path(spark, "llm-records")
    manifest = records.write_records(docs, folder, vocabulary("word_bpe_49k.json"), end_id=2)
    got = records.read_records(spark, folder).orderBy("start").collect()
    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = sorted(((r[0] is not None, r[0] or 0), r[1] or "") for r in corpus())
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [w[0] for w in want]
    start = 0
    for row, (_, text) in zip(got, want):
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert (row.start, row.n_tokens, bytes(row.ids)) == (start, len(ids), ids.tobytes())
        start += len(ids)
    first = manifest.orderBy("part").first()
    store, path = records.open_store(first["file"])
    index = np.frombuffer(store.open_input_stream(records.open_store(first["index"])[1]).read(), "<i8").reshape(-1, 3)
    data = store.open_input_stream(path).read()
    for doc_id, at, size in index[::-1]:  # any order
        chunk = data[at:at + size]
        reader = iter([chunk[:12], chunk[12:]])
        assert (records.unpack_payload(records.unframe(lambda n: next(reader)))[0] or 0) == doc_id
    with pytest.raises(ValueError):
        broken = iter([data[:12], b"\xff" + data[13:index[0][2]]])
        records.unframe(lambda n: next(broken))
    empty = scratch_path(spark, "llm-records-none")
    records.write_records(none, empty, vocabulary("word_bpe_49k.json"), end_id=2)
    assert records.read_records(spark, empty).count() == 0


def test_packing_covers_every_id_once(docs, none):
    path = vocabulary("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path, end_id=1).toPandas()
    want = collections.Counter()
    for r in corpus():
        want[(r[0], len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1)] += 1
    for (doc_id, n), times in want.items():
        mine = rows[(rows.doc_id.isna() if doc_id is None else rows.doc_id == doc_id) & (rows.doc_tokens == n)]
        assert mine.length.sum() == n * times
    for _, seq in rows.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq.offset.tolist() == [0, *seq.length.cumsum().tolist()[:-1]]
        assert seq.length.sum() == seq.context.iloc[0] and seq.context.iloc[0] in [1 << i for i in range(12)]
        assert all(len(i) == 4 * n for i, n in zip(seq.ids, seq.length))
    assert packing.pack_documents(none, path, end_id=1).count() == 0


def test_pack_block_fills_windows():
    rng = random.Random(2)
    pieces = [(i, 0, rng.randint(1, 2047)) for i in range(500)] + [(i, 0, 1500) for i in range(500, 800)]
    packed = packing.pack_block(pieces)
    seen = collections.defaultdict(list)
    for size, window in packed:
        assert sum(p[2] for p in window) == size and size & (size - 1) == 0
        for doc, start, n in window:
            seen[doc].append((start, n))
    for doc, _, n in pieces:
        parts = sorted(seen[doc])
        assert parts[0][0] == 0 and all(a + m == b for (a, m), (b, _) in zip(parts, parts[1:])) and sum(p[1] for p in parts) == n
    assert sum(size < 256 for size, _ in packed) <= 8


@pytest.mark.parametrize("hashed", ["real", "colliding"])
def test_exact_groups(spark, docs, none, hashed):
    from pyspark.sql import functions as F
    fn = F.xxhash64 if hashed == "real" else (lambda c: F.length(c).cast("long"))  # all chunks of a length collide
    rows = chunk_dedup.exact_groups(docs, fn).collect()
    groups = collections.defaultdict(list)
    for r in corpus():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    assert len(rows) == len(corpus())
    for norm, members in groups.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        mine = [r for r in rows if r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()]
        assert len(mine) == len(members) and {r.keep_id for r in mine} == {keep} and {r.group_size for r in mine} == {len(members)}
        assert sum(r.kept for r in mine) == 1
    left = chunk_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert chunk_dedup.exact_groups(none).count() == 0


def test_mixing(spark, docs, none):
    rows = mixing.mix_sources(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    per = collections.Counter()
    for r in corpus():
        per[r[3]] += size(r[1])
    names = sorted((s for s in per if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, budget = {}, set(names), sum(per.values())
    while True:  # water filling, step by step
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * per[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 3 * per[s] for s in full}
        open_ -= full
    source = {r[0]: r[3] for r in corpus()}
    taken = collections.Counter()
    for r in rows:
        assert r.size * 3 >= r.taken >= 0 and r.target == pytest.approx(target[source[r.doc_id]]) and r.source_size == per[source[r.doc_id]]
        taken[source[r.doc_id]] += r.taken
    assert len(rows) == len(corpus()) and all(abs(taken[s] - target[s]) < 1 for s in names)
    assert sorted(rows, key=str) == sorted(mixing.mix_sources(docs).collect(), key=str)
    mix = mixing.mixed_documents(docs)
    assert mix.columns == docs.columns and sum(size(r.text) for r in mix.collect()) == sum(taken.values())
    assert mixing.mix_sources(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def brute_links(texts):
    """doc_id -> smallest doc_id reachable by links of 5-word shingle sets."""
    sets = {d: minmax.shingle_set(re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())) for d, t in texts.items()}
    top = {d: d for d in texts}

    def find(d):
        while top[d] != d:
            d = top[d]
        return d

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {d: find(d) for d in texts}, {d: len(s) for d, s in sets.items()}


def test_near_groups(spark, docs, none):
    rows = minmax.near_groups(docs).collect()
    texts = {r[0]: r[1] for r in corpus() if r[0] is not None}
    group, size = brute_links(texts)
    assert len(rows) == len(corpus())
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (group[r.doc_id], size[r.doc_id], group[r.doc_id] == r.doc_id)
    assert minmax.near_groups(none).count() == 0


def test_near_groups_of_a_family(spark):
    """A family of edited copies, some too far from all others: the groups are those of all pairs."""
    rng = random.Random(9)
    base = syllables(rng, 150).split()
    texts = {}
    for i in range(160):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        texts[i * 3] = " ".join(words)
    path = scratch_path(spark, "llm-family")
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(path)
    group, _ = brute_links(texts)
    assert {r.doc_id: r.component_id for r in minmax.near_groups(spark.read.parquet(path)).collect()} == group


def test_fingerprints(spark, docs, none):
    rows = cws.fingerprints(docs).collect()
    order = sorted(corpus(), key=lambda r: (-(r[0] if r[0] is not None else -1), r[1] or ""))
    texts = [r[1] or "" for r in order]
    want = collections.Counter()
    for i, (r, t) in enumerate(zip(order, texts)):
        half = len(t) // 2
        edited = t[:len(t) - half] + texts[(i + 1) % len(texts)][:half]
        want[(r[0], len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    same = [r for r in rows if r.doc_id in (3, 4)]
    assert len({r.fingerprint for r in same}) == 1
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    assert cws.fingerprints(none).count() == 0


def test_fingerprint_likeness_is_unbiased(spark):
    rng = random.Random(3)
    texts = [syllables(rng, rng.randint(40, 200)) for _ in range(300)]
    path = scratch_path(spark, "llm-cws")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    pairs = lambda t: collections.Counter(zip(t.split(), t.split()[1:]))
    off = []
    for r in cws.fingerprints(spark.read.parquet(path)).collect():
        t, after = texts[r.doc_id], texts[r.doc_id - 1]
        half = len(t) // 2
        a, b = pairs(t), pairs(t[:len(t) - half] + after[:half])
        off.append(r.near_edited - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.11


def test_fuzzy_lines(spark, docs, none):
    rows = {r.doc_id: r for r in fuzzy_lines.dedupe_lines(docs).collect()}
    assert rows[11].text.split("\n")[::2] == ["Line a b c"] and rows[11].n_kept == 2  # the second one repeats the first
    assert rows[12].text == "other words here" and rows[1].text == "" and rows[2].text == " \t\n"
    assert rows[3].text != "" and rows[4].text == ""  # a copy at a later place
    assert fuzzy_lines.dedupe_lines(docs).count() == len(corpus())
    assert fuzzy_lines.dedupe_lines(none).count() == 0


def test_main_text_asks_the_host_about_doubtful_blocks_of_an_article(spark):
    """A class name that only contains a boilerplate word: what the host repeats goes, what a page alone has stays."""
    rng = random.Random(31)
    box, prices = syllables(rng, 12), [syllables(rng, 12) for _ in range(4)]
    bodies = [syllables(rng, 20) for _ in range(4)]
    pages = [(i, f"http://a.org/{i}", f'<article><p>{body}</p><div class="newsletter-box">{box}</div><p class="share-price">{price}</p>'
              f"<p>{bodies[0]}</p></article>", None, None) for i, (body, price) in enumerate(zip(bodies, prices))]
    got = {r.page_id: r.text for r in main_text.main_text(spark.createDataFrame(pages, PAGES)).collect()}
    assert got == {i: f"{bodies[i]}\n{prices[i]}\n{bodies[0]}" for i in range(4)}


def test_fuzzy_lines_joins_variants(spark):
    rng = random.Random(4)
    base = syllables(rng, 400).split()
    variant = list(base)
    variant[200] = "zz"
    path = scratch_path(spark, "llm-lines")
    spark.createDataFrame([(1, " ".join(base)), (2, " ".join(variant) + "\nown line of two"), (3, syllables(rng, 400))],
                          "doc_id long, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    sims = {r.uid: r.simhash for r in fuzzy_lines.occurrences(docs).collect() if r.size == 400}
    rows = {r.doc_id: r for r in fuzzy_lines.dedupe_lines(docs).collect()}
    hashes = sorted(sims.values())
    near = min(bin((a ^ b) & (2**64 - 1)).count("1") for i, a in enumerate(hashes) for b in hashes[:i]) <= fuzzy_lines.MAX_BITS
    assert rows[2].n_kept == (1 if near else 2) and rows[1].n_kept == 1 and rows[3].n_kept == 1


def test_fuzzy_lines_finds_all_similar_pairs(spark):
    """Pairs at edit similarity 0.8 to 0.95 by number of words, against the distance itself."""
    rng = random.Random(12)
    texts, pairs, word = [], [], lambda: syllables(rng, 1) + str(rng.randrange(10**4))
    for n in (4, 5, 6, 7, 9, 10, 14, 15, 20, 24, 25, 27, 40, 60, 100):
        for turn in range(12):
            base = [word() for _ in range(n)]
            other = list(base)
            most = (n + (n < 5)) // 5
            for i in range(rng.choice([1, most]) if turn else most):
                kind = 2 if n < 5 else rng.randrange(2)
                at = i * n // most if turn % 2 else rng.randrange(len(other))  # evenly spread or anywhere
                if kind == 0 and at < len(other):
                    other[at] = word()
                elif kind == 1 and len(other) > 0.8 * n + 1:
                    del other[min(at, len(other) - 1)]
                elif kind == 2:
                    other.insert(at, word())
            pairs.append((n, len(texts)))
            texts += [" ".join(base), " ".join(other)]
    path = scratch_path(spark, "llm-line-pairs")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(path)
    kept = {r.doc_id: r.n_kept for r in fuzzy_lines.dedupe_lines(spark.read.parquet(path)).collect()}
    lost = collections.Counter(n for n, i in pairs if kept[i + 1] and texts[i] != texts[i + 1])
    assert all(kept[i] for _, i in pairs) and not lost, lost


def test_fuzzy_lines_finds_long_lines_whose_first_runs_differ(spark):
    """The runs of most letters are all edited: 20 edits in 100 words leave only runs of short words in common."""
    base = [f"{'extraordinarily' if i < 40 else 'w'}{i}" for i in range(100)]
    other = [f"extraordinarilyother{i}" if i < 40 and i % 2 == 0 else w for i, w in enumerate(base)]
    frame = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(base[::-1]))], "doc_id long, text string")
    path = scratch_path(spark, "llm-long-lines")
    frame.write.parquet(path)
    assert {r.doc_id: r.n_kept for r in fuzzy_lines.dedupe_lines(spark.read.parquet(path)).collect()} == {1: 1, 2: 0, 3: 1}


def test_fuzzy_lines_finds_lines_with_far_simhashes(spark):
    """Edits that repeat one word move the SimHash beyond MAX_BITS, at edit similarity 0.8."""
    base = [f"word{i}" for i in range(80)]
    path = scratch_path(spark, "llm-far-lines")
    spark.createDataFrame([(1, " ".join(base + ["alpha"] * 20)), (2, " ".join(base + ["beta"] * 20)), (3, " ".join(base + ["gamma"] * 21))],
                          "doc_id long, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    sims = {r.d: r.simhash for r in fuzzy_lines.occurrences(docs).collect()}
    assert bin((sims[1] ^ sims[2]) & (2**64 - 1)).count("1") > fuzzy_lines.MAX_BITS
    assert {r.doc_id: r.n_kept for r in fuzzy_lines.dedupe_lines(docs).collect()} == {1: 1, 2: 0, 3: 1}


def test_fuzzy_lines_leaves_less_on_disk_than_it_reads(spark, monkeypatch):
    """No copy of the rows, and no keys of lines, stay; many pairs are checked in portions."""
    rng = random.Random(45)
    monkeypatch.setattr(fuzzy_lines, "PAIRS_AT_ONCE", 1)
    lines = [syllables(rng, 200) for _ in range(2500)]
    texts = ["\n".join(lines[i:i + 10]) for i in range(0, 2500, 10)]
    texts += [" ".join([*lines[i].split()[:-1], "other"]) for i in range(0, 40, 10)]
    path = scratch_path(spark, "llm-line-disk")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(path)
    root = pathlib.Path(checkpoint_root(spark).removeprefix("file:"))
    size = lambda top: sum(f.stat().st_size for f in top.rglob("*.parquet"))
    before = set(root.iterdir())
    rows = fuzzy_lines.dedupe_lines(spark.read.parquet(path)).collect()
    left = sum(size(x) for x in set(root.iterdir()) - before)
    assert {r.doc_id: r.n_kept for r in rows} == {i: 10 if i < 250 else 0 for i in range(254)}
    assert left < size(pathlib.Path(path.removeprefix("file:")))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_fuzzy_lines_simhash_is_the_majority_of_the_words(spark):
    rng = random.Random(46)
    frame = spark.createDataFrame([(n, syllables(rng, n)) for n in (1, 2, 127, 128, 254, 255, 700)], "doc_id long, text string")
    hashes = {r.doc_id: r.h for r in frame.selectExpr("doc_id", "transform(split(text, ' '), x -> xxhash64(x)) h").collect()}
    for r in fuzzy_lines.occurrences(frame).collect():
        words = hashes[r.d]
        assert r.size == len(words) == r.d
        assert r.simhash % 2**64 == sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in words) > len(words))


def test_toxicity(spark, docs, none):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = syllables(rng, 60).split()
        if toxic:
            words[rng.randrange(60)] = rng.choice(["grobian", "grobiane", "grobianen", "lummox"])
        rows.append((i, " ".join(words), "en", "s1", 1, "x", "y", 1))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    marks = spark.createDataFrame(labels + [(10**9, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    path = scratch_path(spark, "llm-tox")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    frame = spark.read.parquet(path)
    model = toxicity.fit(frame, marks)
    got = toxicity.scores(frame, model).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.97
    assert toxicity.drop_toxic(frame, model).count() == sum(r.predicted == 0 for r in got)
    assert toxicity.scores(docs, model).count() == len(corpus()) and toxicity.scores(none, model).count() == 0
    assert toxicity.fit(none, marks) == {} and {r.score for r in toxicity.scores(docs, {}).collect()} == {0.0}



def test_toxicity_trains_on_numbers_of_screened_features_alone(spark, monkeypatch):
    """Of long texts, the one training task gets neither the text nor the features that screening leaves out."""
    rng = random.Random(16)
    ids = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, syllables(rng, 400) + " grobian" * (i % 5 == 0)) for i in ids]
    labels = [(i, int(i % 5 == 0)) for i in ids]

    def train(p, u, names, prior):
        return {"p": p.n, "u": u.n, "p hits": len(p.col), "u hits": len(u.col), **dict.fromkeys(names, 0.0)}

    monkeypatch.setattr(toxicity, "train", train)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = scratch_path(spark, "llm-tox-long")
    frame.write.parquet(path)
    got = toxicity.fit(spark.read.parquet(path), spark.createDataFrame(labels, "doc_id long, toxic int"))
    toxic = sum(t for _, t in labels)
    assert got.pop("p") == toxic and got.pop("u") == len(ids)
    assert set(got) == {"p hits", "u hits", "grob", "groba", "grobi", "grobia", "grobian"} - {"groba"}
    assert got["p hits"] == got["u hits"] == 4 * toxic


PAGE = ('<html><head><title>t</title><script>var a="<p>";</script></head><body><nav><ul><li>menu one two three</ul></nav>'
        '<div class="ad">buy &amp; go</div><article><h1>{t} &copy;</h1><p><b>first\n {t}.<br><p>second &lt;part&gt;'
        '<div class="comments"><p>reader says</div></article><footer>foot</footer>')


def test_main_text(spark):
    plain = "<body><div>site notice that every page of this host repeats again</div><div>{i} own story of page {i} here</div>"
    rows = [(0, "http://h.org/a", PAGE.format(t="x"), "x", "y"), (1, "http://h.org/b", None, "x", "y"), (2, None, "", "x", "y")]
    rows += [(10 + i, "http://q.org/%d" % i, plain.format(i=i * 7), "x", "y") for i in range(3)] + [rows[0]]
    got = main_text.main_text(spark.createDataFrame(rows, PAGES)).collect()
    text = collections.defaultdict(list)
    for r in got:
        text[r.page_id].append(r.text)
    assert text[0] == ["x ©\nfirst x.\nsecond <part>"] * 2 and text[1] == [""] and text[2] == [""]
    assert [text[10 + i] for i in range(3)] == [[f"{i * 7} own story of page {i * 7} here"] for i in range(3)]
    assert main_text.main_text(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("page, want", [
    ("<main class='content has-sidebar'><p>real text</main>", ["real text"]),
    ("<div class='page has-sidebar'><article class='post has-comments'><p>real text</article></div>", ["real text"]),
    ("<article id='search-engines'><section id='related-work'>cited work</section><p class='share-price'>a price<h2 id='login'>Login</h2>"
     "<div class='comments'>reader says</div><nav>menu</nav></article>", ["cited work", "a price", "Login"]),
    ("<main><article class='related'>one</article><div class='social-share'>share it</div></main><div class='ad-box'>buy</div>", ["one"])])
def test_class_words_do_not_drop_articles(page, want):
    assert [" ".join(words) for zone, words in main_text.page_blocks(page) if zone == "article"] == want


def test_runs_are_found_on_a_whole_host(spark):
    """A run on few pages of a large host goes; a page stored several times, or under another menu, keeps its text."""
    rng = random.Random(14)
    notice = "this rare notice stands on very few pages of the host only"
    own = [syllables(rng, 20) + f" {i}" for i in range(1300)]
    rows = [(i, f"http://big.org/{i}", f"<body><div>{own[i]}</div>" + (f"<div>{notice}</div>" if i % 400 == 7 else ""), "x", "y") for i in range(1300)]
    copy = syllables(rng, 30)
    rows += [(5000 + i, f"http://copy.org/{i}", f"<body><nav>{syllables(rng, i + 3)}</nav><div>{copy}</div>", "x", "y") for i in range(4)]
    rows += [(6000, "http://copy.org/a", f"<body><div>{copy}</div>", "x", "y")] * 3
    got = main_text.main_text(spark.createDataFrame(rows, PAGES).repartition(4)).collect()
    assert len(got) == len(rows)
    assert all(r.text == (own[r.page_id] if r.page_id < 5000 else copy) for r in got)


def test_suffix_array_coverage():
    rng = np.random.default_rng(1)
    tokens_ = rng.integers(0, 3, 400).astype(np.uint64)
    page = np.repeat(np.arange(8), 50)
    want = np.zeros(400, bool)
    runs = collections.defaultdict(list)
    for i in range(400 - 7):
        if page[i] == page[i + 7]:
            runs[tuple(tokens_[i:i + 8])].append(i)
    for at in runs.values():
        if len({page[i] for i in at}) > 1:
            for i in at:
                want[i:i + 8] = True
    assert main_text.covered(tokens_, page).tolist() == want.tolist()


def test_url_rules_and_reputation(spark):
    urls = ["http://a.net/x", "HTTP://B.Example.NET/en/1?x", "http://example.com/de/", "ftp://www.org/fr/2#a/b", "http://notnet/x", "none", None,
            "http://x.net", "http://bad.com/7", "http://good.com/8"]
    outcomes = [(1000 + i, f"http://bad.com/{i}", i < 30) for i in range(30)] + [(2000 + i, f"http://good.com/p/{100 + i}.html", False) for i in range(90)]
    pages = [(i, u, "", "x", "y") for i, u in enumerate(urls)] + [(p, u, "", "x", "y") for p, u, _ in outcomes]
    labels = [(int(re.findall(r"\d+", u)[-1]), 1, int(bad)) for _, u, bad in outcomes] + [(None, 0, 1), (5_000_000, None, None)]
    rows = {r.page_id: r for r in url_reputation.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(rows) == len(pages)
    assert [(rows[i].rule, rows[i].verdict) for i in range(4)] == [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    assert [(rows[i].host, rows[i].path, rows[i].rule) for i in (4, 5, 6, 7)] == [("notnet", "/x", None), ("", "", None), ("", "", None), ("x.net", "", None)]
    assert rows[1].host == "b.example.net" and rows[3].path == "/fr/2"
    assert rows[8].verdict == "block" and rows[9].verdict == "allow"
    assert url_reputation.judge(spark.createDataFrame([], PAGES), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_unescape_matches_library():
    assert main_text.page_blocks("<article><p>&eacute;&#65;&nbsp;x</article>")[0][1] == html.unescape("&eacute;&#65;&nbsp;x").split()


def test_bitmap_bounds_the_intersection():
    kernel, rng = minmax.MinMax(), random.Random(8)
    base = syllables(rng, 150).split()
    bits = lambda m: sum(int(x).bit_count() for x in m.view(np.uint64))
    far = 0
    for share in [0.0, 0.01, 0.02, 0.05, 0.1] * 8:
        other = [f"{w}x" if rng.random() < share else w for w in base[:rng.randint(100, 150)]]
        x, y = (kernel.shingles([w.encode() for w in words]) for words in (base, other))
        mx, my = kernel.bitmap(x), kernel.bitmap(y)
        most = bits(mx & my) + min(len(x) - bits(mx), len(y) - bits(my))
        both = len(np.intersect1d(x, y))
        assert both <= most <= min(len(x), len(y))
        far += both < 0.5 * len(x) and 100 * most < 75 * (len(x) + len(y) - most)
    assert far > 0


@pytest.mark.parametrize("job", ["near", "exact", "mix", "lines"])
def test_row_ids_survive_a_new_split_plan(spark, docs, monkeypatch, job):
    """Ids are made in one scan only: with the files split otherwise for each later scan, the results are the same."""
    from pyspark.sql import functions as F
    run = {"near": lambda: minmax.drop_near_duplicates(docs), "exact": lambda: chunk_dedup.drop_exact_duplicates(docs),
           "mix": lambda: mixing.mixed_documents(docs).select("doc_id", "text"), "lines": lambda: fuzzy_lines.dedupe_lines(docs)}[job]
    want = sorted(map(str, run().collect()))
    real, calls = F.monotonically_increasing_id, []

    def other_ids():
        calls.append(1)
        return real() if len(calls) % 2 else (F.lit(1 << 40) - real())  # every second scan numbers its rows otherwise

    monkeypatch.setattr(F, "monotonically_increasing_id", other_ids)
    assert sorted(map(str, run().collect())) == want


def test_fuzzy_lines_with_a_common_phrase_are_no_candidates(spark, monkeypatch):
    """Long lines share a phrase of long words and no more: none is a candidate. Two of them are near copies."""
    rng = random.Random(47)
    phrase = "unsubscribefromthisnewsletter immediatelywithoutanyfurther notificationfromourcompany whatsoeverandindefinitely"
    lines = [f"{syllables(rng, 50)} {phrase} {syllables(rng, 50)}" for _ in range(120)]
    lines.append(" ".join([*lines[3].split()[:-2], "other", "end"]))
    path, buckets, real = scratch_path(spark, "llm-phrases"), [], fuzzy_lines.link
    spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").write.parquet(path)
    monkeypatch.setattr(fuzzy_lines, "link", lambda live, *rest, **more: buckets.append(live.select("node").distinct().count()) or real(live, *rest, **more))
    kept = {r.doc_id: r.n_kept for r in fuzzy_lines.dedupe_lines(spark.read.parquet(path)).collect()}
    assert kept == {i: int(i < 120) for i in range(121)}
    assert buckets == [2]


def test_main_text_asks_the_host_about_open_blocks_beside_an_article(spark):
    """What a page alone has beside its article stays; what the host repeats, and a few words of which it tells nothing, go."""
    rng = random.Random(33)
    box, own, bodies = syllables(rng, 12), [syllables(rng, 12) for _ in range(4)], [syllables(rng, 20) for _ in range(4)]
    pages = [(i, f"http://a.org/{i}", f"<body><div>{lead}</div><div>3 May</div><article><p>{body}</p></article><div>{box}</div>", None, None)
             for i, (lead, body) in enumerate(zip(own, bodies))]
    pages += [(10 + i, f"http://b.org/{i}", f"<body><article><p>{bodies[0]}</p><div class='share-price'>{own[0]}</div></article><div>{side}</div>", None, None)
              for i, side in enumerate(own)]  # copies of one article count once, whatever stands beside it
    got = {r.page_id: r.text for r in main_text.main_text(spark.createDataFrame(pages, PAGES)).collect()}
    assert {i: got[i] for i in range(4)} == {i: f"{own[i]}\n{bodies[i]}" for i in range(4)}
    assert {i: got[10 + i] for i in range(4)} == {i: f"{bodies[0]}\n{own[0]}\n{own[i]}" for i in range(4)}
