"""The operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows, empty
tables and extra columns with clashing names."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshlark.llm import common

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(texts, **extra):
    return [(i, t, extra.get("lang", "en"), f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    base = [prose(rnd, n) for n in (3, 5, 30, 60, 200, 4000)]
    out = [*base, base[2], base[2], None, None, "", " \n ", "one", "One"]
    for _ in range(30):
        words = base[rnd.choice([2, 3, 4])].split()
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = prose(rnd, 1)
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = rows_of(texts)
    return spark.createDataFrame([*rows, rows[2], (None, texts[3], None, None, None), (None, "alone here", None, None, None)], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clash(df):
    """Extra columns with names that the operators use themselves."""
    names = ("node", "digest", "text_hash", "row", "n", "key", "score", "spans", "language", "mix_epoch", "codes", "next", "_order", "_piece")
    return df.withColumns({n: F.lit("x") for n in names})


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


# ---- 1 ------------------------------------------------------------------------------------------------


def classes(rows):
    """Brute force: (first id, copies, links, class) of each text."""
    ids = {}
    for doc, text in rows:
        ids.setdefault(text or "", []).append(doc)
    names = sorted(ids)
    sets = [shingles(t) for t in names]
    links, root = Counter(), list(range(len(names)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(names)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    first = [min((d for d in ids[t] if d is not None), default=None) for t in names]
    least = {}
    for i, f in enumerate(first):
        least[find(i)] = min((x for x in (f, least.get(find(i))) if x is not None), default=None)
    return {t: (first[i], len(ids[t]), links[i], least[find(i)]) for i, t in enumerate(names)}


@pytest.mark.parametrize("block", [1000, 4])
def test_jaccard_links(docs, block, monkeypatch):
    from meshlark.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", block)
    rows = docs.select("doc_id", "text").collect()
    want = classes(rows)
    got = jaccard_join.jaccard_links(clash(docs)).drop("digest").collect()
    assert Counter(tuple(r) for r in got) == Counter((r.doc_id, *want[r.text or ""]) for r in rows)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert len(kept) == len({w[3] for w in want.values() if w[3] is not None}) + sum(w[3] is None for w in want.values())


def test_lone_pairs_at_the_threshold_are_links(spark):
    """40 of 50 shingles in common: J = 0.8 exactly, and nothing else that would bring the two together."""
    from meshlark.llm.jaccard_join import jaccard_links

    rows = []
    for i in range(5000):
        same = [f"w{i}x{k}" for k in range(44)]
        rows += [(2 * i + side, " ".join([*same, *(f"v{i}x{side}x{k}" for k in range(5))])) for side in (0, 1)]
    got = jaccard_links(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and all(r.n_links == 1 and r.class_id == r.doc_id - r.doc_id % 2 for r in got)


def test_jaccard_links_of_nothing(empty):
    from meshlark.llm.jaccard_join import jaccard_links, one_of_each

    assert jaccard_links(empty).count() == 0 and one_of_each(empty).count() == 0


def test_jaccard_tables_stay_smaller_than_near_copies(spark, monkeypatch):
    """Where all texts have near copies, every text is compared: what is written for that is no more than the texts."""
    import os

    from meshlark.llm import jaccard_join

    rnd = random.Random(8)
    rows = []
    for i in range(120):
        words = [rnd.choice("abcdefgh") + rnd.choice("aeiou") + rnd.choice("stvw") for _ in range(300)]
        rows += [(10 * i + k, " ".join([*words, f"copy{k}"])) for k in range(5)]
    written, plain = [], jaccard_join.store

    def watched(df, **measures):
        made = plain(df, **measures)
        written.append(sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(made.path) for f in names if f.endswith(".parquet")))
        return made

    monkeypatch.setattr(jaccard_join, "store", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = jaccard_join.jaccard_links(docs).collect()
    assert len(got) == len(rows) and all(r.n_links == 4 and r.class_id == r.doc_id - r.doc_id % 10 for r in got)
    assert max(written) < sum(len(t) for _, t in rows)


def test_stage_of_near_copies_writes_less_than_it_reads(spark, monkeypatch):
    import os

    import corpus_pipeline
    from meshlark.llm import jaccard_join

    rnd = random.Random(9)
    rows = []
    for i in range(60):
        words = [rnd.choice("abcdefgh") + rnd.choice("aeiou") + rnd.choice("stvw") for _ in range(300)]
        rows += [(10 * i + k, " ".join([*words, f"copy{k}"]), "en") for k in range(5)]
    written, plain = [], jaccard_join.store

    def watched(df, **measures):
        made = plain(df, **measures)
        written.append(sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(made.path) for f in names if f.endswith(".parquet")))
        return made

    monkeypatch.setattr(jaccard_join, "store", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [10 * i for i in range(60)]
    assert max(written) < sum(len(t) for _, t, _ in rows)


def test_shingles_are_dealt_in_few_bytes():
    import pyarrow as pa

    from meshlark.llm.jaccard_join import _dealt

    rnd = random.Random(5)
    texts = [prose(rnd, 300) for _ in range(300)]
    n = sum(len(shingles(t)) for t in texts)
    dealt = list(_dealt(5, None)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])))
    assert sum(len(raw) for b in dealt for raw in b.column(1).to_pylist()) <= 6 * n


def test_pairs_of_blocks_in_rounds(docs, monkeypatch):
    """A text of a group of many blocks is a row for each; a round has few of them, and all rounds have all pairs."""
    from meshlark.llm import jaccard_join

    assert [jaccard_join._rounds(*x) for x in ((None, None), (None, 9), (9, 9), (10, 9), (900, 10))] == [1, 1, 1, 2, 90]
    want = Counter(tuple(r) for r in jaccard_join.jaccard_links(docs).collect())
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", 2)
    taken = []
    monkeypatch.setattr(jaccard_join, "_rounds", lambda *x: taken.append(x) or 3)
    assert Counter(tuple(r) for r in jaccard_join.jaccard_links(docs).collect()) == want and taken[0][0] > 0


def test_pruning_table():
    from meshlark.llm.jaccard_join import HASHES, STEP, least_matches

    table = least_matches(0.8, 1e-6)
    assert len(table) == HASHES // STEP and (np.diff(table) >= 0).all() and 0 < table[-1] < 0.8 * HASHES


# ---- 2 ------------------------------------------------------------------------------------------------


def test_packing_round_trip(docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    from meshlark.llm.packing import pack

    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = pack(clash(docs), path, length=256).collect()
    tokenizer = Tokenizer.from_file(path)
    want = Counter((r.doc_id, tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1])) for r in docs.collect())
    sequences, at = {}, {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        ids = np.frombuffer(p.ids, "<u4")
        assert p.offset == at.get(p.sequence_id, 0)
        at[p.sequence_id] = p.offset + len(ids)
        sequences.setdefault(p.doc_id, []).append((p.start, ids))
        assert at[p.sequence_id] <= p.padded_length
    total = sum(len(ids) * n for (_, ids), n in want.items())
    assert sum(at.values()) == total and all(n == 256 or n & (n - 1) == 0 for n in at.values())
    for doc, parts in sequences.items():
        if doc is not None and sum(n for (d, _), n in want.items() if d == doc) == 1:
            ids = np.concatenate([i for _, i in sorted(parts, key=lambda p: p[0])])
            assert (doc, tuple(ids.tolist())) in want


def test_packing_of_nothing(empty):
    import public_tokenizers

    from meshlark.llm.packing import cut_points, pack

    assert pack(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert cut_points(2048 + 13, 2048).tolist() == [2048, 2056, 2060, 2061]


def test_encoder_agrees_with_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    from meshlark.llm.packing import WordEncoder

    path = public_tokenizers.path("word_bpe_49k.json")
    odd = ["don't THE's a's, x's! 's 't", "é̀ İstanbul ΑΣ ς <|endoftext|> <|ENDOFTEXT|> a<|endoftext|>b",
           "日本語 テスト ﬁ 12a3 b_c", " x\x1cy z", "ÀÉ àé!! ñ... --- a--b", "", " ", "a" * 5000]
    tokenizer = Tokenizer.from_file(path)
    got = WordEncoder(path).encode([t.encode() for t in odd])
    assert [list(g) for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in odd]


@pytest.mark.parametrize("remembered, bits", [(500_000, 21), (40, 6), (0, 4)])
def test_encoder_looks_words_up_by_their_bytes(monkeypatch, remembered, bits):
    """Two lookups in dictionaries for each word took most of the time that the tokenizer did not."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from meshlark.llm import packing

    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    monkeypatch.setattr(packing, "PLACE_BITS", bits)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encoder, rnd = Tokenizer.from_file(path), packing.WordEncoder(path), random.Random(8)
    kinds = ["".join(rnd.choices("abcdeé", k=rnd.choice([1, 2, 7, 8, 9, 15, 16, 17, 30]))) for _ in range(150)]
    kinds += [k + s for k in kinds[:60] for s in (",", "...", "!!x", "'s")] + ["<|endoftext|>", "<|", "x\x00", "x\x00\x00", "x"]
    kinds += [k.upper() for k in kinds[:20]]
    for _ in range(4):
        texts = ["".join(rnd.choice(kinds) + rnd.choice(" \t\n") for _ in range(rnd.randrange(60))).rstrip() for _ in range(30)]
        texts += ["", "a <", "|endoftext|> B", "<|endoftext|>A<|ENDOFTEXT|>", " "]
        got = encoder.encode([t.encode() for t in texts])
        assert [list(g) for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.starts) - 1 == len(encoder.keys[0]) <= max(remembered, 0)
    learned, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: learned.extend(words) or learn(words))
    again = encoder.encode([t.encode() for t in texts])
    assert [list(g) for g in again] == [list(g) for g in got]
    assert not learned if remembered > 1000 else learned


def test_hilbert_neighbours():
    from meshlark.llm.packing import hilbert_key

    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = hilbert_key(cells, bits=3)
    assert sorted(keys) == list(range(512))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


# ---- 3 ------------------------------------------------------------------------------------------------


def test_topk(spark, monkeypatch):
    from meshlark.llm import topk_search

    monkeypatch.setattr(topk_search, "TILE", 7)
    monkeypatch.setattr(topk_search, "ROUND", 3)
    random_ = np.random.RandomState(1)
    rows = [(i, random_.randint(-3, 4, 6).astype(float).tolist()) for i in range(90)]
    rows += [(90, None), (91, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (92, [float("nan")] * 6), (93, [float("inf")] * 6),
             (None, [1.0] * 6), rows[5], (94, [0.0] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    vectors = topk_search.scaled(df, 1.5)
    got = topk_search.largest_products(vectors, vectors.where("vec_id % 10 = 0"), 4).collect()
    clean = {i: [math.floor(1.5 * v) for v in x] for i, x in rows if i is not None and x is not None and i not in (91, 92, 93)}
    want = set()
    for q in clean:
        if q % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(clean[q], x)), i) for i, x in clean.items() if i != q)[:4]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_topk_of_few(spark):
    from meshlark.llm.topk_search import largest_products

    schema = "vec_id long, x array<long>"
    assert largest_products(spark.createDataFrame([], schema), spark.createDataFrame([], schema)).count() == 0
    two = spark.createDataFrame([(0, [1, 2]), (1, [3])], schema)
    assert {tuple(r) for r in largest_products(two, two, 10).collect()} == {(0, 1, 1, 3), (1, 1, 0, 3)}


# ---- 4 ------------------------------------------------------------------------------------------------


def test_language_fusion(spark, empty):
    from meshlark.llm.language_id import fit_language_model, identify

    words = {"en": "the with and from this that".split(), "de": "und nicht der die schön über".split()}
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choices(words[lang], k=30)), lang, "h" + lang, 1) for i in range(80) for lang in [("en", "de")[i % 2]]]
    train = spark.createDataFrame(rows, DOCS)
    model = fit_language_model(train, languages=("de", "en"))
    odd = [(100, None, None, None, None), (101, "", "en", "hen", 0), (102, "123 456 !!", "en", None, 0), (103, "die", None, None, 3),
           (104, "und nicht der", "en", "hde", 3), (104, "und nicht der", "en", "hde", 3), (105, "xq", None, "hen", 2)]
    df = clash(train.union(spark.createDataFrame(odd, DOCS)))
    got = identify(df, model, declared=F.col("lang"), host=F.col("source"))
    assert got.columns[-3:] == ["language", "language_posterior", "language_kept"] and set(df.columns) <= set(got.columns)
    found = [(r.doc_id, r.language, r.language_kept) for r in got.collect()]
    assert len(found) == 87
    by = dict((d, (l, k)) for d, l, k in found)
    assert all(by[i] == (("en", "de")[i % 2], True) for i in range(80))
    assert by[100] == by[101] == by[102] == ("und", False) and by[103][0] == "de" and by[104] == ("de", True)
    assert sum(d == 104 for d, _, _ in found) == 2
    assert identify(empty, model).count() == 0
    assert identify(empty, fit_language_model(empty)).count() == 0


# ---- 5 ------------------------------------------------------------------------------------------------


def test_scores(docs, empty):
    from meshlark.llm.suffix_tree_lm import score_texts

    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = score_texts(clash(docs), held).collect()
    rows = docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held")).collect()
    counts = Counter()
    for r in rows:
        if not r.held:
            counts.update((r.text or "").encode().lower().split())
            counts[None] += 1
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for r in rows:
        tokens = [*(r.text or "").encode().lower().split(), None]
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        want[(r.doc_id, r.held, len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert score_texts(empty, held).count() == 0
    assert all(r.train_tokens == 0 and r.score < 0 for r in score_texts(docs, F.lit(True)).collect())


def test_tree_sums_to_one():
    from meshlark.llm.suffix_tree_lm import END, OTHER, SuffixTree, strings

    root = np.full(END + 1, 1e-300)
    root[[0, 1, 2, OTHER, END]] = 0.4, 0.3, 0.1, 0.1, 0.1
    tree = SuffixTree(np.log(root))
    tree.grow(np.array([0, 0, 1], np.uint64), np.array([1, 2, 0], np.uint64), np.array([60, 20, 50]), 1.0, {0: 90, 1: 55})
    tree.grow(np.array([1, 1], np.uint64), np.array([0, 2], np.uint64), np.array([30, 28]), 1.0, {1: 60})  # after 0, then 1
    every = np.array([0, 1, 2, OTHER, END], np.uint64)
    for state, depth in ((0, 0), (0, 1), (1, 1), (1, 2), (2, 1)):
        p = np.exp(tree.log_probability(np.full(5, state, np.uint64), np.full(5, depth), every))
        assert abs(p.sum() - 1) < 1e-9
    state, depth = strings(np.array([5, 6, END, 7, OTHER, 8, END], np.uint64), np.array([0, 3]))
    assert depth.tolist() == [0, 1, 2, 0, 1, 0, 1] and int(state[2]) == 5 << 16 | 6


def tree_scores(rows):
    """Brute force: the score of each (id, text, held) by a suffix tree in dictionaries, states and pairs seen twice."""
    def tokens(text):
        return [*(text or "").encode().lower().split(), None]

    grams = Counter()
    for _, text, held in rows:
        t = tokens(text)
        if not held:
            grams.update(tuple(t[i:i + k]) for k in range(1, 5) for i in range(len(t) - k + 1))
    total, words = sum(n for g, n in grams.items() if len(g) == 1), sum(len(g) == 1 and g != (None,) for g in grams)
    once, twice = (sum(n == m and len(g) == 1 and g != (None,) for g, n in grams.items()) for m in (1, 2))
    discount = once / (once + 2 * twice) if twice else 0.5
    unknown, states = max(discount * words / total, 1e-12), {}

    def p(context, token):
        while context:
            if context in states:
                after, rest = states[context]
                return after[token] if token in after else rest * p(context[1:], token)
            context = context[1:]
        n = grams[(token,)]
        return n / total if token is None else (n - discount) / total if n else unknown

    for k in range(2, 5):
        after = {}
        for g, n in grams.items():
            if len(g) == k and n >= 2:
                after.setdefault(g[:-1], {})[g[-1]] = n
        level = {}
        for s, next_ in after.items():
            every, kinds = grams[s], len(next_)
            parent = {t: p(s[1:], t) for t in next_}
            own = {t: (n + kinds * parent[t]) / (every + kinds) for t, n in next_.items()}
            rest = max(1 - sum(own.values()), 1e-9) / max(1 - sum(parent.values()), 1e-9)
            gain = sum(n * math.log2(own[t] / parent[t]) for t, n in next_.items()) + (every - sum(next_.values())) * math.log2(rest)
            if gain >= 16:
                level[s] = own, rest
        states.update(level)
    assert any(grams[s] == 2 for s in states)
    return {i: sum(math.log10(p(tuple(t[max(0, j - 3):j]), t[j])) for j in range(len(t))) for i, text, _ in rows for t in [tokens(text)]}


@pytest.mark.parametrize("head", [1_000_000, 1000])
def test_scores_against_a_brute_force_tree(spark, monkeypatch, head):
    """More tokens than a fixed share of the corpus or a fixed alphabet lets through: 300,000 tokens, 80,000 kinds."""
    from meshlark.llm import suffix_tree_lm

    monkeypatch.setattr(suffix_tree_lm, "HEAD", head)
    rnd = random.Random(11)
    passages = [[f"w{rnd.randrange(90_000)}" for _ in range(6)] for _ in range(300)]
    rows = [(-1, None, False), (-2, " ", True), (-3, "never", True), (-4, "never", True)]
    for i in range(150):
        words = [f"w{min(rnd.randrange(90_000), rnd.randrange(90_000) if j % 3 else rnd.randrange(200))}" for j in range(2000)]
        for _ in range(4):
            words[rnd.randrange(2000):0] = rnd.choice(passages)
        rows.append((i, " ".join(words), i % 7 == 2))
    got = suffix_tree_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string, held boolean"), F.col("held")).collect()
    want = tree_scores(rows)
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.score - want[r.doc_id]) < 1e-6 * max(1, abs(want[r.doc_id]))


def test_scoring_keeps_no_table_but_the_values(spark, docs):
    """Levels, counts and filters were left on disk while the texts were scored."""
    from pathlib import Path

    from meshlark.llm.suffix_tree_lm import score_texts
    from meshlark.plans.lineage import shared_folder

    def tables():
        folder = Path(shared_folder(spark).removeprefix("file:")) / "tables" / spark.sparkContext.applicationId
        return {p.relative_to(folder).parts[0] for p in folder.rglob("*.parquet")}

    before = tables()
    assert score_texts(docs, F.col("doc_id") % 7 == 2).count() == docs.count()
    assert len(tables() - before) == 1


# ---- 6 ------------------------------------------------------------------------------------------------


def covered(rows, length):
    seen = Counter(t[s:s + length] for _, t in rows for s in range(len(t) - length + 1))
    out = []
    for doc, t in rows:
        mark = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if seen[t[s:s + length]] > 1:
                mark[s:s + length] = True
        edges = np.diff(np.concatenate(([0], mark.astype(int), [0])))
        out.append((doc, len(t), tuple(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())),
                    np.frombuffer(t, np.uint8)[~mark].tobytes()))
    return Counter(out)


@pytest.mark.parametrize("large", [512, 2])
def test_repeats(spark, large, monkeypatch):
    from meshlark.llm import repeats

    monkeypatch.setattr(repeats, "LARGE_GROUP", large)
    rnd = random.Random(4)
    base = ["".join(rnd.choice("abcé ") for _ in range(n)) for n in (90, 150, 400)]
    texts = [None, "", "ab" * 300, base[2], base[2]]
    for _ in range(50):
        text = ""
        for _ in range(rnd.randint(1, 3)):
            p = rnd.choice(base)
            a = rnd.randrange(len(p))
            text += p[a:rnd.randint(a, len(p))] + "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9)))
        texts.append(text)
    rows = [*enumerate(texts), (3, base[2]), (None, base[1])]
    df = clash(spark.createDataFrame(rows, "doc_id long, text string"))
    got = repeats.remove_repeats(df, 100).collect()
    plain = [(d, (t or "").encode()) for d, t in rows]
    assert Counter((r.doc_id, r.n_bytes, tuple((s.start, s.stop) for s in r.spans), bytes(r.kept)) for r in got) == covered(plain, 100)
    by = dict(plain)
    groups = {}
    for r in repeats.maximal_repeats(df.where("doc_id IS NOT NULL"), 100).collect():
        groups.setdefault((r.gram, r.number, r.n_bytes), set()).add(by[r.doc_id][r.start:r.start + r.n_bytes])
        assert r.n_bytes >= 100
    assert groups and all(len(g) == 1 for g in groups.values())


def test_repeats_of_nothing(spark):
    from meshlark.llm.repeats import remove_repeats

    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(spark.createDataFrame([], "doc_id long, text string"), 64)


def test_interval_tree_lists_maximal_groups():
    """Every group with all its members, against all pairs: a pair's own stretch, and whoever else holds it."""
    from meshlark.llm.repeats import maximal_groups

    rnd = random.Random(8)
    for _ in range(40):
        before = ["".join(rnd.choice("xy") for _ in range(rnd.randint(0, 6))).encode() for _ in range(9)]
        after = [("a" + "".join(rnd.choice("bc") for _ in range(rnd.randint(0, 6)))).encode() for _ in range(9)]
        want = set()
        for i in range(9):
            for j in range(i):
                left = len(os.path.commonprefix([before[i], before[j]]))
                right = len(os.path.commonprefix([after[i], after[j]]))
                if left + right >= 4:
                    members = tuple(m for m in range(9) if before[m][:left] == before[i][:left] and len(before[m]) >= left
                                    and after[m][:right] == after[i][:right] and len(after[m]) >= right)
                    want.add((left, right, members))
        got = [(left, right, tuple(sorted(m))) for left, right, m in maximal_groups(before, after, 4)]
        assert len(set(got)) == len(got) and set(got) == want


# ---- 7 ------------------------------------------------------------------------------------------------


def test_mix(spark, empty):
    from meshlark.llm.mixing import mix

    rnd = random.Random(5)
    rows = [(i, prose(rnd, rnd.randint(0, 12)), "en", ("hot" if i % 3 else f"s{i % 5}") if i % 11 else None, 0) for i in range(600)]
    rows += [rows[1], (None, "a b", None, "hot", 0), (700, None, None, "none", 0), (701, "", None, "none", 0)]
    docs = clash(spark.createDataFrame(rows, DOCS))
    got = mix(docs, most_repeats=2.0, block_tokens=500)
    assert got.columns == [c for c in docs.columns if c != "mix_epoch"] + ["mix_epoch", "mix_block", "mix_key", "mix_tokens"]
    out = got.collect()
    tokens, read, held = Counter(), Counter(), Counter(r[:2] for r in rows)
    for r in rows:
        tokens[r[3]] += len((r[1] or "").split())
    for r in out:
        read[r.source] += r.mix_tokens
        assert r.mix_tokens == len((r.text or "").split())
    assert all(read[s] <= 2 * tokens[s] + 1 for s in tokens)
    assert read["s0"] > 1.5 * tokens["s0"] and read["hot"] < tokens["hot"]
    assert abs(sum(read.values()) - sum(tokens.values())) < 0.1 * sum(tokens.values())
    assert sum(r.source == "none" for r in out) == 2 and max(r.mix_epoch for r in out) <= 2
    assert max(Counter((r.doc_id, r.text) for r in out)[k] / n for k, n in held.items()) <= 2
    flat = Counter()
    for r in mix(docs, least_entropy=0.999, most_repeats=None).collect():
        flat[r.source] += r.mix_tokens
    share = np.array([n for n in flat.values() if n]) / sum(flat.values())
    assert -(share * np.log(share)).sum() > 0.97 * math.log(len(share))
    assert mix(empty).count() == 0


def test_mix_of_one_source_reads_every_row_once(spark):
    """A budget of all tokens is each block's own tokens, whatever the shares are in floating point."""
    from pyspark.sql import functions as F

    from meshlark.llm.mixing import mix

    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"),
                                    F.lit("text").alias("text"))
    got = mix(docs, tokens=F.col("doc_id") % 89 + 1, block_tokens=150)
    assert got.count() == 3000 and got.select("doc_id").distinct().count() == 3000
    assert got.select("mix_block").distinct().count() > 500


# ---- 8 ------------------------------------------------------------------------------------------------


def test_fingerprints(spark, docs, empty, monkeypatch):
    from meshlark.llm import fingerprints

    got = fingerprints.edited_likeness(clash(docs).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).orderBy("doc_id").collect()
    texts = [r.text or "" for r in docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()]
    seen = {}
    for i, r in enumerate(got):
        after = texts[(i + 1) % len(texts)]
        half = len(texts[i]) // 2
        edited = texts[i][:len(texts[i]) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert seen.setdefault(texts[i], r.fingerprint) == r.fingerprint
        a, b, c = shingles(texts[i]), shingles(edited), shingles(after)
        for near, x in ((r.near_edited, b), (r.near_next, c)):
            true = len(a & x) / len(a | x) if a | x else 1.0
            assert abs(near - true) < 0.2
    assert fingerprints.edited_likeness(docs).count() == docs.count() and fingerprints.edited_likeness(empty).count() == 0


def test_next_over_many_stretches(spark):
    from meshlark.llm.fingerprints import with_next

    rows = [(i * 7 % 101, f"t{i}") for i in range(101)]
    got = with_next(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], piece_rows=4).collect()
    assert {(r.doc_id, r.next.doc_id) for r in got} == {(i, (i + 1) % 101) for i in range(101)}


# ---- 9 ------------------------------------------------------------------------------------------------


def test_quality(spark, docs, empty):
    from meshlark.llm.quality import fit_quality, score_quality

    rnd = random.Random(6)
    good = [(i, prose(rnd, 40)) for i in range(0, 240, 2)]
    bad = [(i, " ".join(w + "###" for w in prose(rnd, 40).split()) if i % 3 else (prose(rnd, 1) + " ") * 40) for i in range(1, 240, 2)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(240)] + [(None, 1), (3, None), (900, 1)], "doc_id long, quality int")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = fit_quality(table, labels, ~held)
    scored = score_quality(clash(table), model).withColumn("held", held).where("held").collect()
    assert sum((r.score >= 0.3) == (r.doc_id % 2 == 0) for r in scored) >= 0.95 * len(scored)
    every = score_quality(docs, model).collect()
    assert len(every) == docs.count() and all(0 <= r.score <= 1 for r in every)
    assert score_quality(empty, model).count() == 0
    blank = fit_quality(empty, labels, ~held)
    assert {r.score for r in score_quality(docs, blank).collect()} == {0.5}


# ---- 10 -----------------------------------------------------------------------------------------------

BASE = ["mail a.b@c.de, x@y, 1.2.3.4 256.1.1.1 1.2.3.4.5", "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (212) 555-0199 +1 2",
        "a@b.c@d.e", "@@a@b.c", "", None, "é a@b.de", "x" * 5000 + "@" + "y" * 5000, "1" * 3000 + ".1.1.1", "+1" + "(" * 3000]


def plain_spans(text):
    import re

    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m[0])
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]


def test_plain_personal_data(spark):
    from meshlark.llm.personal_data import detect, find_personal_data

    rnd = random.Random(8)
    many = ["".join(rnd.choice("a1.@+ -(") for _ in range(rnd.randint(1, 60))) for _ in range(3000)]
    for text in [*(t or "" for t in BASE[:8]), BASE[10], *many]:
        assert detect(text) == plain_spans(text), text
    df = clash(spark.createDataFrame([*enumerate(BASE), (0, BASE[0]), (None, BASE[1])], "doc_id long, text string"))
    got = find_personal_data(df).collect()
    assert len(got) == len(BASE) + 2
    assert all(r.spans == [] for r in got if r.doc_id in (5, 6))


@pytest.mark.parametrize("text, kind, found", [
    ("mail john.doe (at) example (dot) com now", "email", "john.doe (at) example (dot) com"),
    ("write to jane at mail dot example dot org please", "email", "jane at mail dot example dot org"),
    ("call plus one two one two five five five zero one nine nine ok", "phone", "plus one two one two five five five zero one nine nine"),
    ("jоhn＠exаmple.com", "email", "jоhn＠exаmple.com"),
    ("4111​1111​1111​1111", "card", "4111​1111​1111​1111"),
    ("ip one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("é +１ (212) 555-0199", "phone", "+１ (212) 555-0199")])
def test_disguises_map_back(text, kind, found):
    from meshlark.llm.personal_data import find

    spans = find(text)
    assert [(k, text[a:b], base) for k, a, b, base in spans] == [(kind, found, False)]


def test_clean_text_stays(spark, empty, docs):
    from meshlark.llm.personal_data import find, redact

    for text in ("we are at home. dot com", "one two three", "ten at the end dot", "meet me at noon (at) last", "Élan à l'école · déjà"):
        assert find(text) == []
    df = spark.createDataFrame([(1, "a@b.de x 1.2.3.4", "en", "s", 5), (2, None, None, None, None), (3, "", "en", "s", 0)], DOCS)
    out = {r.doc_id: r for r in redact(df).collect()}
    assert out[1].text == "[EMAIL] x [IP]" and out[1].n_chars == 14 and out[2].text is None and out[3].text == ""
    assert redact(empty).count() == 0 and redact(docs).schema == docs.schema


# ---- shared helpers -----------------------------------------------------------------------------------


def test_shingle_sets_agree_with_text():
    texts = ["a b c d e f", "A b  c\td e\nf", "x", "", " ", "a b c d e f a b c d e"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    sets = list(common.shingles(data, offsets, 5))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert (sets[0] == sets[1]).all() and np.isin(sets[0], sets[5]).all()


def test_components(spark):
    rnd = random.Random(9)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(500, 500 + i) for i in range(50)]
    root = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == {(n, r) for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert len(got) == len({r.node for r in got})
    assert zlib.crc32(b"0") >= 0


# ---- modules ------------------------------------------------------------------------------------------


def test_every_module_finds_what_it_imports():
    import importlib
    import pkgutil

    import meshlark

    for module in pkgutil.walk_packages(meshlark.__path__, "meshlark."):
        importlib.import_module(module.name)


def test_kernels_hold_little_more_than_a_slice():
    """Less than 2 MB of text took 83 MB while its shingles were counted, 19 MB in smaller slices."""
    import tracemalloc

    import pyarrow as pa

    from meshlark.llm.jaccard_join import _dealt

    rnd = random.Random(4)
    batch = pa.RecordBatch.from_arrays([pa.array([prose(rnd, 300) for _ in range(1500)])], ["text"])
    assert batch.nbytes > 1_500_000
    common._powers.clear()
    tracemalloc.start()
    rows = sum(b.num_rows for b in _dealt(5, None)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows and peak < 50e6


def test_tree_query_hands_few_rows_to_python(spark):
    """10,000 texts or packed parts at a time are tens of megabytes, held by the JVM and by Python."""
    from meshlark.llm.queries import QUERIES
    from tests.conftest import DATA

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        found = QUERIES["op5_suffix_tree_lm"](spark, DATA)
        assert int(spark.conf.get(name)) <= 500
        assert found.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
    finally:
        spark.conf.set(name, before)


def test_asked_strings_are_packed_without_loss():
    """They took 16 bytes each, with the byte that their part tells and the number of their task."""
    from meshlark.llm import suffix_tree_lm as lm

    rnd = np.random.default_rng(5)
    for bits in (8, 13):
        gram, text = rnd.integers(0, 2**64, 5000, np.uint64), np.sort(rnd.integers(0, 2**32, 5000, np.uint64)).astype(np.uint32)
        text[:9] = [7, 3, 2**32 - 1, 0, 5, 5, 4, 1, 9]
        dealer = lm._Dealer(bits)
        dealer.add(0, 0, lm._ASKED, gram, np.full(5000, 70_001, np.uint32), text)
        got, packed = [], 0
        for batch in dealer.out():
            for part, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                packed += len(raw)
                got += zip(*(c.tolist() for c in lm._asked([raw], part, bits)))
        assert Counter(got) == Counter(zip(gram.tolist(), (text.astype(np.uint64) | np.uint64(70_001 << 32)).tolist()))
        assert packed < 16 * 5000


def test_tree_query_hands_few_bytes_to_python(spark):
    """500 packed parts at a time were up to 50 MB, held by the JVM and by Python."""
    from meshlark.llm.queries import QUERIES
    from tests.conftest import DATA

    names = [f"spark.sql.execution.arrow.{x}PerBatch" for x in ("maxBytes", "maxRecords")]
    before = [spark.conf.get(name) for name in names]
    try:
        spark.conf.set(names[0], str(1 << 28))
        QUERIES["op5_suffix_tree_lm"](spark, DATA)
        assert int(spark.conf.get(names[0])) <= 4_000_000
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_small_inputs_have_few_parts(spark, docs, monkeypatch):
    """Each task made a row for each of 256 parts, however few strings there were."""
    from meshlark.llm import suffix_tree_lm as lm

    seen, level = [], lm._level
    monkeypatch.setattr(lm, "_level", lambda pairs, shorter, bits, gain: seen.append(bits) or level(pairs, shorter, bits, gain))
    found = lm.score_texts(docs, F.lit(False)).collect()
    assert len(found) == docs.count() and seen and max(seen) <= 6


@pytest.mark.parametrize("bits", [3, 6, 8, 13])
def test_asked_strings_of_few_parts_keep_their_first_byte(bits):
    """A part of fewer than 8 bits does not tell the first byte."""
    from meshlark.llm import suffix_tree_lm as lm

    rnd = np.random.default_rng(6)
    gram, text = rnd.integers(0, 2**64, 3000, np.uint64), np.arange(3000, dtype=np.uint32)
    dealer = lm._Dealer(bits)
    dealer.add(0, 0, lm._ASKED, gram, np.full(3000, 9, np.uint32), text)
    got = {}
    for batch in dealer.out():
        for part, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            found, row = lm._asked([raw], part, bits)
            assert (found >> np.uint64(64 - bits) == part).all()
            got |= dict(zip((row & np.uint64(2**32 - 1)).tolist(), found.tolist()))
    assert got == dict(enumerate(gram.tolist()))


@pytest.mark.parametrize("shared", [0, 8, 13])
@pytest.mark.parametrize("size", [0, 1, 2, 5000])
def test_strings_are_found_by_their_first_bits(size, shared):
    """Binary search over a million strings took two thirds of the time of scoring."""
    from meshlark.llm.suffix_tree_lm import _Index

    rnd = np.random.default_rng(size)
    low = np.uint64(64 - shared) if shared else None
    grams = np.unique(np.append(rnd.integers(0, 2**64, size, np.uint64), rnd.integers(0, 300, size, np.uint64)))
    wanted = np.concatenate((grams, grams + np.uint64(1), rnd.integers(0, 2**64, 4000, np.uint64), np.array([0, 2**64 - 1], np.uint64)))
    if shared:  # all of one part
        own = np.uint64(5) << low
        grams = np.unique(grams & ((np.uint64(1) << low) - np.uint64(1)) | own)
        wanted = wanted & ((np.uint64(1) << low) - np.uint64(1)) | own
    hit, at = _Index(grams, shared).find(wanted)
    assert (hit == np.isin(wanted, grams)).all()
    assert (grams[at[hit]] == wanted[hit]).all()


@pytest.mark.parametrize("shared", [70, 110, 130, 260])
def test_crowded_grams_do_not_make_a_row_for_each_string(spark, monkeypatch, shared):
    """Each of the surroundings of a gram of very many kinds became a row for each string it holds."""
    from meshlark.llm import repeats

    made, store = [], repeats.store
    monkeypatch.setattr(repeats, "LARGE_GROUP", 20)
    monkeypatch.setattr(repeats, "store", lambda df, **k: made.append((df.columns, r := store(df, **k))) or r)
    rnd = random.Random(shared)
    letters = "".join(rnd.choices("abcdefgh é", k=400))
    common_part = letters[:shared]
    texts = [None, "", letters]
    for i in range(60):
        before, after = ("".join(rnd.choices("abcdefgh é", k=120)) for _ in range(2))
        # Half of the texts go on alike after the part, a third of them have the same text before it.
        texts.append((letters[300:380] if i % 3 == 0 else before) + common_part + (letters[shared:shared + 9 + i] if i % 2 else after))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = repeats.remove_repeats(df, 100).collect()
    plain = [(d, (t or "").encode()) for d, t in enumerate(texts)]
    assert Counter((r.doc_id, r.n_bytes, tuple((s.start, s.stop) for s in r.spans), bytes(r.kept)) for r in got) == covered(plain, 100)
    around = sum(r.rows for columns, r in made if columns == ["gram", "around", "n", "before", "bytes"])
    rounds = [r.rows for columns, r in made if "string" in columns or columns[2:4] == ["core", "kind"]]
    assert max(rounds) > 20 and max(rounds) <= 2 * around


def test_pipeline_hands_few_bytes_to_python(spark):
    """2,000 packed rows of a join at a time are tens of megabytes, held by the JVM and by Python."""
    import corpus_pipeline

    names = [f"spark.sql.execution.arrow.{x}PerBatch" for x in ("maxBytes", "maxRecords")]
    before = [spark.conf.get(name) for name in names]
    try:
        spark.conf.set(names[0], str(1 << 28))
        corpus_pipeline._bounded(spark)
        assert int(spark.conf.get(names[0])) <= 4_000_000
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_packing_query_holds_few_rows_at_a_time(spark):
    """10,000 texts to Python and 4,096 from a file at a time made the JVM's heap grow to 1.4 GB and more."""
    from meshlark.llm.queries import QUERIES
    from tests.conftest import DATA

    limits = {"spark.sql.execution.arrow.maxBytesPerBatch": (1 << 28, 1_000_000), "spark.sql.execution.arrow.maxRecordsPerBatch": (10_000, 1000),
              "spark.sql.parquet.columnarReaderBatchSize": (4096, 256)}
    before = {name: spark.conf.get(name) for name in limits}
    try:
        for name, (usual, _) in limits.items():
            spark.conf.set(name, str(usual))
        pieces = QUERIES["op2_packing"](spark, DATA)
        assert all(int(spark.conf.get(name)) <= most for name, (_, most) in limits.items())
        assert pieces.select("doc_id").distinct().count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
