"""Token alignment, vector codes and URL filter against brute force, on small tables with nulls, empty and very long
texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA

DOCS = "doc_id long, text string"


def paths():
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


# Token alignment

@pytest.fixture(scope="module")
def spelled():
    """Whole texts encoded by both libraries: ``text -> [(id, start, stop)] of A, of B``, or None."""
    import sentencepiece
    import tiktoken  # the same vocabulary by another library
    import base64
    import public_tokenizers as P

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    a = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    of_rank = {i: t for t, i in ranks.items()}
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def placed(ids, of):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(of(i))))
            at += len(of(i))
        return out

    def spell(text):
        if not text:
            return None
        ids_a, ids_b = a.encode_ordinary(" " + text), b.encode(text)
        raw = (" " + text).encode()
        if b"".join(map(of_rank.get, ids_a)) != raw or b"".join(map(bytes_b, ids_b)) != raw:
            return None
        return placed(ids_a, of_rank.get), placed(ids_b, bytes_b)

    return spell


def aligned(rows, spell):
    """The contract, document by document."""
    linked, out, holds = [], [], Counter()
    for _, text in rows:
        found = spell(text)
        if found is None:
            linked.append(None)
            continue
        a, b = found
        both = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, start = [], 0
        for end in both:
            groups.append(",".join(str(x[0]) for x in a if start <= x[1] < end) + "|"
                          + ",".join(str(x[0]) for x in b if start <= x[1] < end) if len(a) < 400 else "")
            start = end
        links, j = Counter(), 0
        for i, s, e in a:
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links[i, b[k][0]] += 1
                k += 1
        holds.update(links.keys())
        linked.append((len(a), len(b), len(both), links, ";".join(groups) if len(a) < 400 else None))
    top = defaultdict(int)
    for (i, _), n in holds.items():
        top[i] = max(top[i], n)
    for (doc_id, _), found in zip(rows, linked):
        if found is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, groups = found
        out.append((doc_id, n_a, n_b, n_groups, links.total(), sum(m for p, m in links.items() if holds[p] == top[p[0]]),
                    sum(m * holds[p] for p, m in links.items()), groups))
    return out, holds, top


@pytest.fixture(scope="module")
def odd_texts():
    rnd = random.Random(5)
    signs = ["a", "be", "Über", "naïve", " ", "  ", "\n", "\t", "\r\n", "中文", "😀", "it's", "don't", "1234", "x.y", "</s>", "<|endoftext|>",
             "\u00a0", "\u3000", "\x1c", "\x85", "...", "émeu", "\u0301", "ﬁ", "\x00"]
    mixed = ["".join(rnd.choice(signs) for _ in range(rnd.randint(1, 30))) for _ in range(300)]
    return [None, "", " ", "  ", "\n", " \n ", "a ", " a", "a  b", "a \n  \n b", "▁x", "x ▁ y", "<s>one</s>", "word", "word",
            "word " * 30_000, "z" * 3000, *mixed]


def test_alignment_equals_whole_texts(spark, spelled, odd_texts, monkeypatch):
    from meshlark.llm import token_alignment as ta

    rows = [(n, t) for n, t in enumerate(odd_texts)] + [(3, "word"), (None, "word and more")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({n: F.lit("x") for n in ("block", "part", "groups", "keys", "n_a")})
    want, holds, top = aligned(rows, spelled)
    for bytes_each, salts in ((ta.BLOCK_BYTES, ta.GROUP_BYTES), (2_000, 300)):  # many blocks, many merges
        monkeypatch.setattr(ta, "BLOCK_BYTES", bytes_each)
        monkeypatch.setattr(ta, "GROUP_BYTES", salts)
        got = ta.align(docs.repartition(5), *paths()).collect()
        assert [r.asDict() for r in got[:1]][0].keys() == {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"}
        plain = Counter((r.doc_id, *r[1:7], r.groups if r.n_a < 400 else None) for r in got)
        assert plain == Counter((w[0], *w[1:7], w[7] if w[1] < 400 else None) for w in want)
    pairs = ta.linked_pairs(docs, *paths()).collect()
    assert {(p.a_id, p.b_id): (p.n_docs, p.is_best) for p in pairs} == {p: (n, n == top[p[0]]) for p, n in holds.items()}
    digests = {r.doc_id: r.groups for r in ta.align(docs, *paths(), digest=True).collect()}
    assert all(digests[w[0]] == (hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "")
               for w in want if w[7] is not None and w[0] != 3)


def test_alignment_of_the_documents(spark, spelled):
    from meshlark.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want, _, _ = aligned(docs, spelled)
    got = QUERIES["op11_token_alignment"](spark, DATA).collect()
    assert Counter(tuple(r[:7]) for r in got) == Counter(w[:7] for w in want)
    said = {r.doc_id: r.groups_sha256 for r in got}
    assert all(said[w[0]] == (hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "") for w in want if w[7] is not None)


def test_alignment_of_nothing(spark):
    from meshlark.llm.token_alignment import align, linked_pairs

    none = spark.createDataFrame([], DOCS)
    assert align(none, *paths()).count() == 0 and linked_pairs(none, *paths()).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], DOCS)
    assert [tuple(r) for r in align(blank, *paths()).orderBy("doc_id").collect()] == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]


def test_merged_runs(monkeypatch):
    from meshlark.llm import token_alignment as ta

    monkeypatch.setattr(ta, "FRAME", 7)
    rnd = np.random.RandomState(1)
    runs, want = [], Counter()
    for _ in range(9):
        keys = np.unique(rnd.randint(0, 200, rnd.randint(0, 90)).astype(np.uint64))
        counts = rnd.randint(1, 5, len(keys)).astype(np.uint64)
        want.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append(ta._run(keys, counts))
    parts = list(ta.merged(runs))
    keys = np.concatenate([p[0] for p in parts])
    assert (np.diff(keys.astype(np.int64)) > 0).all()
    assert dict(zip(keys.tolist(), np.concatenate([p[1] for p in parts]).tolist())) == want
    big = np.array([0, 1, (1 << 63) + 5], np.uint64)
    assert (ta._unpacked(ta._packed(big, "<u8"), "<u8") == big).all()


# Vector codes

VECTORS = "vec_id long, embedding array<float>, label int"


def codes_of(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = max(1, -(-max(len(v) for _, v, _ in kept) // parts)) * parts
    kept = [(i, v + [0] * (size - len(v)), lab) for i, v, lab in kept]
    width = size // parts
    seeds = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    books = [[list(v[p * width:(p + 1) * width]) for _, v in seeds] for p in range(parts)]

    def near(p, v):
        part = v[p * width:(p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [[list(e) for e in book] for book in books]
        for p in range(parts):
            of = defaultdict(list)
            for _, v, _ in kept:
                of[near(p, v)[1]].append(v[p * width:(p + 1) * width])
            for n, own in of.items():
                new[p][n] = [sum(c) // len(own) for c in zip(*own)]
        books = new
    coded = []
    for i, v, lab in kept:
        found = [near(p, v) for p in range(parts)]
        coded.append((i, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found), lab))
    totals = Counter()
    for _, _, e, lab in coded:
        totals[lab] += e
    text = ",".join(str(c) for book in books for e in book for c in e)
    return Counter((i, c, e, totals[lab]) for i, c, e, lab in coded), hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def vector_rows():
    rnd = random.Random(9)
    rows = [(rnd.randint(-5, 400), [rnd.gauss(0, 0.02) for _ in range(6)], rnd.choice([1, 2, None])) for _ in range(200)]
    rows += [(n, [0.25, -0.25, 0.5, 0.0, 0.0, 1.0], 3) for n in range(900, 1000)]  # many copies
    rows += [rows[0], (rows[0][0], [9.0] * 6, 1), (None, [0.1] * 6, 2), (7, None, 1), (8, [None, 1.0], 1), (9, [float("nan")] * 6, 1),
             (10, [float("inf")] * 6, 1), (11, [], 1), (12, [0.5], 1), (5000, [0.1] * 8, None)]
    return [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]


@pytest.mark.parametrize("parts,entries,rounds", [(4, 16, 2), (2, 256, 1), (3, 5, 0)])
def test_vector_codes(spark, vector_rows, monkeypatch, parts, entries, rounds):
    from meshlark.llm import vector_codes as vc

    monkeypatch.setattr(vc, "SEGMENT", 16)
    df = spark.createDataFrame(vector_rows, VECTORS).withColumns({n: F.lit("x") for n in ("code", "error", "cell", "v", "x")})
    books = vc.fit_codebooks(df.repartition(3), parts, entries, rounds)
    want, digest = codes_of(vector_rows, parts, entries, rounds, 256)
    got = vc.encode(df, books).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == want
    assert vc.codebooks_digest(books) == digest
    one = next(r for r in got if r.vec_id == 5000)
    back = vc.decode(one.code, books)
    assert ((back - np.pad([math.floor(256 * 0.1)] * 8, (0, len(back) - 8))) ** 2).sum() == one.error


def test_vector_codes_of_nothing_and_of_too_much(spark):
    from meshlark.llm.vector_codes import encode, fit_codebooks

    none = spark.createDataFrame([], VECTORS)
    assert encode(none, fit_codebooks(none)).count() == 0
    bad = spark.createDataFrame([(1, None, 1), (2, [float("nan")], 1)], VECTORS)
    assert encode(bad, fit_codebooks(bad)).count() == 0
    nameless = spark.createDataFrame([(None, [1.0], 1)], VECTORS)
    assert encode(nameless, fit_codebooks(nameless)).count() == 0  # no entry to assign to
    huge = spark.createDataFrame([(1, [3e38] * 64, 1), (2, [-3e38] * 64, 1), (3, [3e38] * 64, 1)], VECTORS).drop("label")
    rows = encode(huge, fit_codebooks(huge, rounds=0, entries=1)).collect()
    assert sorted(r.error for r in rows) == [0, 0, 64 * (1 << 28) ** 2] and {r.label for r in rows} == {None}


def test_trie_shares_prefixes_and_ties(monkeypatch):
    from meshlark.llm import vector_codes as vc

    book = np.array([[0, 0], [2, 0], [0, 0]])
    parts = np.array(sorted({(a, b) for a in range(-3, 4) for b in range(-3, 4)}))
    for segment in (1, 5, 100):
        monkeypatch.setattr(vc, "SEGMENT", segment)
        got = [(c, d) for _, codes, least in vc.trie_assign(parts, book) for c, d in zip(codes.tolist(), least.tolist())]
        want = [min((((p - e) ** 2).sum(), n) for n, e in enumerate(book)) for p in parts]
        assert got == [(n, d) for d, n in want]


# URL filter

def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    cut = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path[:cut]


def plain_rule(rules, host, path):
    fits = [(len(r), -n, r, v) for n, (v, r) in enumerate(rules)
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return max(fits)[2:] if fits else (None, None)


def plain_score(model, host, path):
    """N-gram by n-gram, with integers for the hashes."""
    from meshlark.llm import common, url_filter

    raw, mask = f"\x02{host}\x03{path}\x04".encode(), (1 << 64) - 1
    total, count = 0.0, 0
    for n in url_filter.GRAMS:
        for at in range(len(raw) - n + 1):
            h = sum(int(common.BYTE_VALUES[raw[at + k]]) * pow(common._BASE, k, 1 << 64) for k in range(n)) + n & mask
            h ^= h >> 33
            h = h * 0xFF51AFD7ED558CCD & mask
            h ^= h >> 33
            h = h * 0xC4CEB9FE1A85EC53 & mask
            h ^= h >> 33
            total += model.weights[(h >> 40) % url_filter.BUCKETS]
            count += 1
    return 1 / (1 + math.exp(-(model.constant + total / math.sqrt(max(count, 1)))))


URLS = [None, "", "no scheme", "http://", "http://A.Example.NET", "http://a.example.net/en/x?y#z", "http://example.net/en", "http://example.net/EN/",
        "x://y://z/w", "https://Ünet/ä?b", "http://net/", "http://.net/", "http://notnet/", "http://a.b.c.d.e.org/fr/1", "http://org/fr/#/de/",
        "http://example.com?q=/de/", "http://example.com/de/", "http://sub.example.com/de/x", "http://u@example.com:80/de/", "://net/",
        "http://ex\nample.com/d\ne/", "http://a.net/" + "long/" * 50_000, "http://a.org/fr/", "http://a.org/fr/"]


def test_urls(spark):
    from meshlark.llm import url_filter as uf
    from meshlark.llm.queries import URL_RULES

    df = spark.createDataFrame([(n, u, "old", n) for n, u in enumerate(URLS)], "page_id long, url string, host string, text long")
    rules = URL_RULES + [("allow", "e.org/fr/"), ("block", "/"), ("block", "com/de/"), ("allow", "com/de/")]
    model = uf.fit_url_model(uf.apply_rules(df, rules))
    got = uf.judge_urls(df, rules, model).collect()
    assert got[0].asDict().keys() == {"page_id", "url", "text", "host", "path", "rule", "score", "verdict"} and len(got) == len(URLS)
    for r in got:
        assert (r.host, r.path) == plain_parts(r.url) and r.text == r.page_id
        rule, verdict = plain_rule(rules, r.host, r.path)
        assert r.rule == rule
        if len(r.path) < 1000:
            assert abs(r.score - plain_score(model, r.host, r.path)) < 1e-9
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    none = df.where("false")
    assert uf.judge_urls(none, rules, uf.fit_url_model(uf.apply_rules(none, rules))).count() == 0
    with pytest.raises(ValueError):
        uf.Rules([("maybe", "net/")])


def test_training_steps():
    """Each step against a dense computation."""
    from meshlark.llm import common, url_filter as uf
    import pyarrow as pa

    texts, blocked = ["\x02a.net\x03/x\x04", "\x02b.org\x03/y\x04", "\x02c.net\x03/\x04"], [True, False, True]
    data, offsets = common.utf8(pa.array(texts))
    x = np.zeros((3, uf.BUCKETS))
    for row, bucket in uf.gram_buckets(data, offsets):
        np.add.at(x, (row, bucket), 1)
    x /= np.sqrt(x.sum(1, keepdims=True))
    w, c, past, past_c = np.zeros(uf.BUCKETS), 0.0, np.full(uf.BUCKETS, 1e-8), 1e-8
    y, share = np.array([1.0, 0, 1]), np.array([0.25, 0.5, 0.25])
    for _ in range(uf.EPOCHS):
        slope = (1 / (1 + np.exp(-(x @ w + c))) - y) * share
        step = x.T @ slope + uf.DECAY * w
        past, past_c = past + step ** 2, past_c + slope.sum() ** 2
        w, c = w - uf.RATE * step / np.sqrt(past), c - uf.RATE * slope.sum() / np.sqrt(past_c)
    model = uf.train(texts, blocked)
    assert np.allclose(model.weights, w) and math.isclose(model.constant, c)


def test_model_carries_rules_over(spark):
    """Learned from three quarters of the hosts that rules decide, tried on the rest."""
    from meshlark.llm import url_filter as uf
    from meshlark.llm.queries import URL_RULES

    pages = spark.read.parquet(DATA.replace("0.001", "0.01") + "/pages.parquet").select("page_id", "url")
    labelled = uf.apply_rules(pages, URL_RULES).where("rule IS NOT NULL").drop("score")
    model = uf.fit_url_model(labelled.where("crc32(host) % 4 <> 0"))
    rest = uf.judge_urls(labelled.where("crc32(host) % 4 = 0").withColumnRenamed("verdict", "rule_says"), [], model).collect()
    assert len(rest) > 20 and sum(r.verdict == r.rule_says for r in rest) >= 0.95 * len(rest)


def test_url_query(spark):
    from meshlark.llm.queries import QUERIES, URL_RULES

    pages = {r.page_id: r.url for r in spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url").collect()}
    got = QUERIES["op13_url_filter"](spark, DATA).collect()
    assert len(got) == len(pages)
    for r in got:
        rule, verdict = plain_rule(URL_RULES, *plain_parts(pages[r.page_id]))
        assert (r.host, r.path) == plain_parts(pages[r.page_id]) and r.rule == rule
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
