"""Small cases of each operator: nulls, empty and long texts, ties, repeated
rows, empty tables, clashing column names; planted pairs and clusters."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripweave.llm import (best_fit, bpe_codec, chat_format, components, embed_dedup, host_rules, language_id,
                           license_scan, ngram_join, token_files, token_cache, toxicity)
from tripweave.llm.common import written

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "a b c d e f"), (5, "é ß 中 " * 3000),
       (6, "word " * 30000), (7, "###  $$$\n\n--"), (8, "x" * 50000)]


def rows(df):
    return [r.asDict() for r in df.collect()]


# ------------------------------------------------------------------ tokens
def test_codec_and_cache_equal_the_library_on_odd_texts():
    from tokenizers import Tokenizer
    spec = token_cache.tokenizer_text()
    library = Tokenizer.from_str(spec)
    own, cache = bpe_codec.codec(spec)
    other = token_cache.library_ids(spec)
    r = random.Random(1)
    alphabet = ["a", "b", " ", "  ", "\n", " \n", "\t", "the", "'s", "'t", "<|endoftext|>", "é", "ß", "中", "\xa0",
                "\x1c", "\x85", "1", "½", "🙂", "\x00", "...", ".", ",", ".\n", "_.", "###", "İ", "​", "　", "Ⅷ", "é"]
    for _ in range(1500):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 14)))
        want = library.encode(text, add_special_tokens=False).ids
        for c in (cache, other):
            assert np.frombuffer(c.packed(text), "<u4").tolist() == want, text
        assert own.decode(np.array(want, int)) == library.decode(want, skip_special_tokens=False)
    for _ in range(300):   # ids that are not a text
        ids = [r.randrange(50257) for _ in range(5)]
        assert own.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_cache_generations_do_not_change_results():
    spec = token_cache.tokenizer_text()
    own, _ = bpe_codec.codec(spec)
    small = token_cache.ChunkIds(own.encode_chunk, cap=3)
    texts = ["a b c d e", "e d c b a f g", "long" * 40 + " a b"] * 3
    large = token_cache.ChunkIds(own.encode_chunk)
    assert [small.packed(t) for t in texts] == [large.packed(t) for t in texts]
    assert all(len(k) <= 64 for k in large)


def test_words_hold_the_most_ids_that_fit():
    """Widths by 16-bit parts and selectors by sliding maxima, against coding id by id."""
    r = np.random.default_rng(8)
    edges = np.array([0, 1, 2**16 - 1, 2**16, 2**32, 2**53 + 1, 2**60 - 1, 2**60, 2**64 - 1], np.uint64)
    some = [edges, np.zeros(130, np.uint64), np.zeros(0, np.uint64)]
    some += [r.integers(0, 2**63, 400, dtype=np.uint64) >> r.integers(lo, 63, 400).astype(np.uint64) for lo in (0, 30, 45, 55, 60)]
    for x in some:
        assert token_files.bit_widths(x).tolist() == [int(i).bit_length() for i in x]
        want, at = [], 0
        while at < len(x):
            widest = [max(int(i).bit_length() for i in x[at:at + n]) for n in token_files.COUNT]
            want.append(next((s for s in range(1, 16) if widest[s] <= token_files.BITS[s]), 0))
            at += int(token_files.COUNT[want[-1]])
        words, escapes = token_files.pack_words(x)
        assert (words >> np.uint64(60)).tolist() == want
        assert escapes.tolist() == [i for i in x.tolist() if i >= 2**60]
        assert (token_files.unpack_words(words, escapes, len(x)) == x).all()


def test_encode_decode_odd_rows(spark, texts):
    enc = bpe_codec.encode(texts(ODD))
    assert Counter(r["doc_id"] for r in rows(enc)) == Counter(i for i, _ in ODD)
    back = Counter((r["doc_id"], r["text"]) for r in rows(bpe_codec.decode(enc)))
    assert back == Counter((i, t or "") for i, t in ODD)
    assert rows(bpe_codec.digests(bpe_codec.encode(texts([])))) == []


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60000) | st.just(0), max_size=400))
@settings(max_examples=150, deadline=None)
def test_simple8b_round_trip(ids):
    x = np.array(ids, np.uint64)
    words, escapes = token_files.pack_words(x)
    assert (token_files.unpack_words(words, escapes, len(x)) == x).all()


def test_block_reads_single_documents():
    r = np.random.default_rng(3)
    arrays = [r.integers(0, top, n).astype(np.uint64) for n, top in ((0, 9), (5000, 50257), (1, 2), (9000, 2), (0, 3), (70, 2**63))]
    block = token_files.Block(token_files.write_block([1, None, 3, 3, 5, 6], arrays))
    assert block.doc_ids == [1, None, 3, 3, 5, 6]
    for i, a in enumerate(arrays):
        assert (block.document(i) == a).all()


def test_token_files_odd_rows(spark, texts):
    path = token_files.write_files(texts(ODD), block_ids=100)
    got = rows(token_files.read_digests(spark, path))
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in ODD)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):   # gapless, ascending, nulls first
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: (r["start"], r["n_tokens"]))]
    assert order[0] is None and order[1:] == sorted(order[1:])
    assert rows(token_files.read_digests(spark, token_files.write_files(texts([])))) == []


# ----------------------------------------------------------------- packing
def fewest(items, capacity):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in set(bins):
            if room >= items[i]:
                rest = list(bins)
                rest[rest.index(room)] -= items[i]
                go(i + 1, rest)
        go(i + 1, [*bins, capacity - items[i]])

    go(0, [])
    return best[0]


@given(st.lists(st.integers(1, 20), max_size=9))
@settings(max_examples=100, deadline=None)
def test_solver_is_optimal_on_small_inputs(items):
    plan = best_fit.solve(dict(Counter(items)), 20)
    placed = Counter()
    for kind, times in plan:
        assert sum(k * n for k, n in kind) <= 20
        for k, n in kind:
            placed[k] += n * times
    assert placed == Counter(items)
    assert sum(t for _, t in plan) == fewest(sorted(items, reverse=True), 20) >= best_fit.lower_bound(Counter(items), 20)


def test_solver_places_everything_whatever_the_node_limit():
    counts = {700: 1000, 600: 1001, 500: 3, 41: 77, 2048: 5}
    for nodes in (1, 10, 1000):
        placed = Counter()
        for kind, times in best_fit.solve(dict(counts), 2048, nodes):
            for k, n in kind:
                placed[k] += n * times
        assert placed == counts


def test_only_long_documents_are_cut():
    assert best_fit.cut(2048, 2048) == [(0, 2048)]
    assert best_fit.cut(2049, 2048) == [(0, 1), (1, 2048)]
    assert best_fit.cut(5, 2048) == [(0, 5)]


def test_pack_odd_rows(spark, texts):
    got = rows(best_fit.pack(texts(ODD), capacity=64))
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        assert [o for o, _ in sorted(places)] == list(np.cumsum([0, *(n for _, n in sorted(places))])[:-1])
        assert sum(n for _, n in places) <= 64
    assert Counter(str(r["doc_id"]) for r in got if r["piece"] == 0) == Counter(str(i) for i, _ in ODD)
    total = sum(r["length"] for r in got)
    assert len(by_sequence) <= -(-total // 64) + 1
    assert rows(best_fit.pack(texts([]))) == []


# ------------------------------------------------------------- components
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=25))
@settings(max_examples=6, deadline=None)
def test_components_equal_union_find(spark, pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = rows(components.components(spark.createDataFrame(pairs, "x long, y long")))
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for p in pairs for x in p}
    assert len(got) == len({x for p in pairs for x in p})


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 900)] + [(None, 3), (7, 7)]
    got = {r["node"]: r["component"] for r in rows(components.components(spark.createDataFrame(chain, "a long, b long")))}
    assert got == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 900)} | {7: 7}


# ---------------------------------------------------------- n-gram Jaccard
def brute_classes(docs, width=5, pct=80):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            n = len(sets[x] & sets[y])
            if x < y and n and 100 * n >= pct * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, families=12, per=14):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    docs, i = [], 0
    for f in range(families):
        base = [r.choice(vocabulary) for _ in range(r.choice([4, 20, 90, 200]))] + (passage if f % 3 == 0 else [])
        for _ in range(per):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 60))):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            docs.append((i, " ".join(w).upper() if r.random() < 0.3 else "\n".join(w)))
            i += 1
    return docs


def passage_chain(n, seed=6):
    """Texts of 400 words, of which 50 are also in the next one."""
    r = random.Random(seed)
    some = lambda k: [f"w{r.randrange(5000)}" for _ in range(k)]
    passages = [some(50) for _ in range(n + 1)]
    return [(i, " ".join(some(100) + passages[i] + some(100) + passages[i + 1] + some(100))) for i in range(n)]


@pytest.mark.parametrize("tile,max_tiles", [(20_000, 64), (300, 64), (300, 1)])
def test_join_equals_brute_force(spark, texts, monkeypatch, tile, max_tiles):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "MAX_TILES", max_tiles)
    docs = near_copies(tile + max_tiles) + [(900, None), (901, ""), (902, " \t"), (903, "a b"), (904, "A  b")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(ngram_join.classes(texts(docs)))}
    assert got == brute_classes(docs)


def test_large_group_of_near_copies_ships_few_texts(spark, texts, monkeypatch):
    """1,500 near copies, 4 of 400 words changed in each, in 75 tiles: every two link."""
    monkeypatch.setattr(ngram_join, "TILE", 8_000)
    shipped, verify = [], ngram_join._verify
    monkeypatch.setattr(ngram_join, "_verify", lambda dealt, *rest: (shipped.append(dealt.count()), verify(dealt, *rest))[1])
    r = random.Random(3)
    base = [f"w{r.randrange(5000)}" for _ in range(400)]
    docs = []
    for i in range(1500):
        w = list(base)
        for at in r.sample(range(400), 4):
            w[at] = f"x{r.randrange(10**9)}"
        docs.append((i, " ".join(w)))
    docs += [(2000, " ".join(base[:200] + [f"y{k}" for k in range(200)])), (2001, "another text of some words here")]
    got = {r["doc_id"]: r["component_id"] for r in rows(ngram_join.classes(texts(docs)))}
    assert got == {i: 0 for i in range(1500)} | {2000: 2000, 2001: 2001}
    assert sum(shipped) < 4 * len(docs)


def test_passage_chain_in_a_crowded_table_ships_few_texts(spark, texts, monkeypatch):
    """240 texts, each with a passage of the one before and one of the next, too
    little for a link; 4,096 counters for 95,000 shingles; and four near copies."""
    monkeypatch.setattr(ngram_join, "TABLE_BITS", (12, 12))
    monkeypatch.setattr(ngram_join, "TILE", 2_000)
    monkeypatch.setattr(ngram_join, "MAX_TILES", 4)
    shipped, verify = [], ngram_join._verify
    monkeypatch.setattr(ngram_join, "_verify", lambda dealt, *rest: (shipped.append(dealt.count()), verify(dealt, *rest))[1])
    docs = passage_chain(240)
    docs += [(1000 + i, docs[100][1].replace(" ", "  ") + f" end{i} of it") for i in range(4)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(ngram_join.classes(texts(docs)))}
    assert got == brute_classes(docs)
    assert sum(shipped) < len(docs)


def test_near_copies_of_two_sizes_stay_close(spark):
    """Pairs go by what their prefixes share; a shingle of many documents keeps them."""
    r = np.random.default_rng(8)
    held = {i: r.choice(60, 25, replace=False).tolist() for i in range(40)}
    got = rows(ngram_join._close(spark.createDataFrame(
        [(t, 0, i, 60 + i) for i, ts in held.items() for t in ts] + [(99, 5, i, 200) for i in range(500, 700)],
        "token long, leader long, doc_id long, n long"), 80))
    behind = lambda n: -(-n * 80 // 100) - 1 - n // ngram_join.EXTRA
    want = {(a, b) for a in held for b in held if a < b and 100 * (60 + a) >= 80 * (60 + b) and
            len(set(held[a]) & set(held[b])) >= max(1, -(-80 * (120 + a + b) // 180) - max(behind(60 + a), behind(60 + b)))}
    assert want and len(want) < 780
    assert {(x["a"], x["b"]) for x in got} == want | {(5, i) for i in range(500, 700)}


def test_parts_meet_other_parts_only(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 10)
    part = {i: 0 if i < 12 else 50 if i < 24 else i if i < 27 else None for i in range(30)}
    groups = spark.createDataFrame([(1, i, 5, part[i]) for i in part] + [(2, i, 5, 7) for i in range(5)] + [(3, 1, 5, None)],
                                   "key long, doc_id long, n long, part long")
    cells = {}
    for r in rows(ngram_join.deal(groups)):
        cells.setdefault((r["key"], r["lo"], r["hi"]), []).append((r["doc_id"], r["tile"]))
    met = {(a, b) for (_, lo, hi), held in cells.items() for a, x in held for b, y in held
           if a < b and (lo == hi or x != y)}
    want = {(a, b) for a in part for b in part if a < b and (part[a] is None or part[a] != part[b])}
    assert want <= met and not any(part[a] == part[b] for a, b in met if max(a, b) < 24)
    assert {key for key, *_ in cells} == {1}


def test_join_reports_every_link_on_request(spark, texts):
    docs = near_copies(5, families=6, per=6)
    _, links = ngram_join.join(texts(docs), every=True)
    sets = {i: frozenset(ngram_join.shingles(t).tolist()) for i, t in docs}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    reps = sorted(first.values())
    want = {(a, b) for a in reps for b in reps
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    got = {(r["a"], r["b"]) for r in rows(links)}
    copy = lambda x: first[sets[x]]
    assert {tuple(sorted((copy(a), copy(b)))) for a, b in got if copy(a) != copy(b)} == want


def test_join_odd_rows(spark, texts):
    got = rows(ngram_join.classes(texts(ODD)))
    assert len(got) == len(ODD)
    assert {r["doc_id"]: r["n_shingles"] for r in got if r["doc_id"] in (1, 2, 3, 4)} == {1: 0, 2: 0, 3: 0, 4: 1}
    assert rows(ngram_join.classes(texts([]))) == []


# --------------------------------------------------------------- embeddings
def test_embedding_dedup_equals_brute_force(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal((300, 24))
    for k in range(0, 120, 3):                       # planted clusters
        x[k + 1] = x[k] + 0.1 * r.standard_normal(24)
        x[k + 2] = x[k] * 2.0
    x[120:200] = x[120] + 0.12 * r.standard_normal((80, 24))
    x[200:230] = x[200]
    vectors = [(int(i), [float(c) for c in v], "z", 3) for i, v in enumerate(x)]
    vectors += [(900, None, "z", 3), (901, [0.0] * 24, "z", 3), (902, [float("nan")] + [1.0] * 23, "z", 3),
                (903, [None] + [1.0] * 23, "z", 3), (904, [], "z", 3), (905, [1e300] * 24, "z", 3),
                (906, [2e-300] * 24, "z", 3), (907, [1.0] * 5, "z", 3), (None, [1.0] * 24, "z", 3)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, rep string, n int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows(embed_dedup.dedup(df, miss=1e-6))}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    for i in range(len(u)):
        assert got[i][0] == near[i].sum()
    assert got[200][1] == 200 and got[229] == (29 + (near[229, :200].sum() + near[229, 230:].sum()), got[200][1], False)
    assert all(got[i] == (0, i, True) for i in (900, 901, 902, 903, 904, 907)) and got[906] == (1, 905, False)
    assert got[None][0] == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert rows(embed_dedup.dedup(empty)) == []


def test_tiles_split_a_hot_bucket(spark):
    r = np.random.default_rng(5)
    base = r.standard_normal(16)
    x = base + 0.05 * r.standard_normal((90, 16))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, v array<double>")
    pairs = rows(embed_dedup.near_pairs(written(df, "t"), 90, tile=16))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i in range(90) for j in range(i + 1, 90) if u[i] @ u[j] >= 0.95}
    got = [(p["a"], p["b"]) for p in pairs]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.99 * len(want)


# -------------------------------------------------------------- chat format
@given(st.lists(st.sampled_from([*"ab\\\n<>[]|/", *chat_format.CONTROL]), max_size=30).map("".join))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    assert chat_format.unescape(chat_format.escape(text)) == text
    assert not any(c in chat_format.escape(text) for c in chat_format.CONTROL)
    assert chat_format.unescape_line(chat_format.escape_line(text)) == text
    assert "\n" not in chat_format.escape_line(text)


def test_template_language():
    t = chat_format.Template(
        "{# note #}{% for m in messages %}{% if loop.first %}<{% elif m['role'] == 'b' and not loop.last %}B"
        "{% else %}-{% endif %}{{ m.text ~ 1 }}{% generation %}{{ 'x' + m.text | upper }}{% endgeneration %}{% endfor %}!")
    text, loss = t.render(messages=[{"role": "a", "text": "q"}, {"role": "b", "text": "r"}, {"role": "b", "text": "s"}])
    assert text == "<q1xQBr1xR-s1xS!"
    assert [text[a:b] for a, b in loss] == ["xQ", "xR", "xS"]


def test_constants_are_folded():
    tree = chat_format.fold(chat_format.parse("a{{ 'b' + ('c' | upper) }}{% if 1 == 2 %}no{% else %}d{% endif %}{{ x }}"))
    assert tree == ("all", ("print", ("const", "abCd")), ("print", ("name", "x")))


@pytest.mark.parametrize("source", ["{{ x() }}", "{{ x.__class__ }}", "{{ x | eval }}", "{% import os %}", "{% if x %}",
                                    "{{ 1 + }}", "{% for x %}{% endfor %}", "{{ x.1 }}"])
def test_template_sandbox(source):
    with pytest.raises(chat_format.TemplateError):
        chat_format.Template(source)


def test_format_odd_rows(spark):
    data = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"), (None, 0, None, "</s>"),
            (None, None, "us\ner", "<|im_end|>\n"), (2, 0, "assistant", ""), (3, 0, "user", "y" * 200000)]
    df = spark.createDataFrame([(*r, "x") for r in data], "conv_id long, turn long, role string, text string, loss string")
    out = {r["conv_id"]: r for r in rows(chat_format.format_conversations(df))}
    assert chat_format.read_turns(out[1]["formatted"]) == [("user", ""), ("assistant", "b"), ("assistant", "b")]
    assert chat_format.read_turns(out[None]["formatted"]) == [("us\ner", "<|im_end|>\n"), ("", "</s>")]
    assert [(s["start"] == s["end"]) for s in out[2]["loss"]] == [True]
    assert len(out[3]["formatted"]) > 200000
    assert rows(chat_format.digests(chat_format.format_conversations(df.limit(0)))) == []


# ---------------------------------------------------------- rules and models
def test_repeat_words_and_lines(spark):
    texts = ["a b c a b c", "a a a a", "x y z", "x y", "", None, "a b c d e a b c", "l1\nl1\n \nl2\nl1", "p q r s p q r s p q"]

    def brute(t):
        w = (t or "").split()
        at = defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i:i + 3])].append(i)
        return len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)})

    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in rows(host_rules.measure(df))}
    assert {i: got[i]["n_repeat_words"] for i in got} == {i: brute(t) for i, t in enumerate(texts)}
    assert got[7]["n_dup_lines"] == 2 and got[5]["n_words"] == 0


def test_host_rates_shrink_to_the_common_rate(spark):
    good, bad = "w%d " * 60, "no"
    data = []
    for h in range(10):
        data += [(f"h{h}", (good % tuple(range(k, k + 60))) if k % 10 else bad) for k in range(40)]
    data += [("junk", bad)] * 40 + [("one", bad), (None, bad), (None, good % tuple(range(60)))]
    df = spark.createDataFrame([(i, t, s, True) for i, (s, t) in enumerate(data)],
                               "doc_id long, text string, source string, kept boolean")
    measured = host_rules.measure(df)
    hosts = {r["source"]: r for r in rows(host_rules.host_verdicts(measured))}
    assert hosts["junk"]["host_failed"] and not hosts["h1"]["host_failed"]
    assert hosts["one"]["rate_base"] < 1 and None not in hosts
    out = rows(host_rules.judge(measured))
    assert len(out) == len(data)
    assert all(r["kept"] == (not r["base_failed"] and not r["host_failed"]) for r in out)
    assert rows(host_rules.judge(host_rules.measure(df.limit(0)))) == []


def test_language_odd_rows(spark, texts):
    labelled = spark.createDataFrame([("the and of " * 5, "en"), ("der die und " * 5, "de"), (None, "en"), ("xx", None)],
                                     "text string, lang string")
    model = language_id.train(labelled)
    assert model.languages == ["de", "en"]
    got = rows(language_id.predict(texts(ODD + [(20, "12 34 ½")]), model))
    assert len(got) == len(ODD) + 1 and {"source", "n", "tokens"} <= set(got[0])
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 7, 20)} == dict.fromkeys((1, 2, 3, 7, 20), "und")
    assert model.predict(["und die der", "of the and"])[0] == ["de", "en"]
    nothing = language_id.train(labelled.limit(0))
    assert nothing.predict(["abc"]) == (["und"], [0.0])


def test_toxicity_locates_the_sentence(spark):
    r = random.Random(2)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu") for b in ("ra", "ne", "so", "pi", "vu")]
    docs, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        s = [" ".join(r.choice(words) for _ in range(8)) for _ in range(6)]
        if toxic:
            s[r.randrange(6)] += " " + r.choice(["vilegrub", "nastything"]) + " " + r.choice(["vilegrub", "nastything"])
        docs.append((i, ". ".join(s) + ".", 0.5))
        labels.append((i, int(toxic), "x"))
    d = spark.createDataFrame(docs, "doc_id long, text string, toxicity double")
    lab = spark.createDataFrame(labels + [(None, 1, "x"), (9999, 1, "x"), (3, None, "x")], "doc_id long, toxic int, h string")
    model = toxicity.train(d, lab)
    out = rows(toxicity.score(d, model))
    right = sum((o["toxicity"] >= 0.7) == (o["doc_id"] % 5 == 0) for o in out)
    assert right >= 390
    for o in out:
        if o["doc_id"] % 5 == 0 and o["offending"]:
            text = docs[o["doc_id"]][1]
            assert any("vile" in text[s["start"]:s["end"]] or "nasty" in text[s["start"]:s["end"]] for s in o["offending"])
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (None, "vilegrub nastything vilegrub")], "doc_id long, text string")
    assert {o["doc_id"]: o["toxicity"] for o in rows(toxicity.score(odd, model)) if o["doc_id"]} == {1: 0.0, 2: 0.0, 3: 0.0}
    untrained = toxicity.train(d, lab.limit(0))
    assert {o["toxicity"] for o in rows(toxicity.score(d, untrained))} == {0.0}


def rare_toxicity(documents, toxic, seed=6):
    """(doc_id, text) in which each of the ``toxic`` ids has a sentence of two bad words."""
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu") for b in ("ra", "ne", "so", "pi", "vu")]
    docs = []
    for i in range(documents):
        s = [" ".join(r.choice(words) for _ in range(8)) for _ in range(4)]
        if i in toxic:
            s[r.randrange(4)] += " vilegrub nastything"
        docs.append((i, ". ".join(s) + "."))
    return docs


def test_toxicity_of_rare_labels_and_missing_documents(spark):
    toxic = set(range(0, 3000, 150))     # 20 of 3,000 documents
    docs = spark.createDataFrame(rare_toxicity(3000, toxic), "doc_id long, text string")
    # nine labels of ten, toxic ones too, have no document
    labels = spark.createDataFrame([(i, int(i in toxic or i % 2 and i >= 3000)) for i in range(30_000)],
                                   "doc_id long, toxic int")
    model = toxicity.train(docs, labels, max_docs=60)   # 0.4 toxic ones in 60 of 3,000 labels
    assert {o["doc_id"] for o in rows(toxicity.score(docs, model)) if o["toxicity"] >= 0.7} == toxic


def test_toxicity_without_a_bag_of_one_label_has_the_counted_weights(spark):
    toxic = set(range(0, 600, 30))
    texts = [(i, t * (40 if i in toxic else 1)) for i, t in rare_toxicity(600, toxic)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, max_chars=1000)   # every toxic text is longer
    assert {o["doc_id"] for o in rows(toxicity.score(docs, model)) if o["toxicity"] >= 0.7} == toxic


def test_license_scan_odd_rows(spark, texts):
    notice = license_scan.NOTICES["MIT"]
    data = ODD + [(30, "lorem ipsum " * 200 + notice + " dolor " * 300), (31, notice.upper()), (32, "released under the"), (31, notice.upper())]
    got = Counter((r["doc_id"], r["license_id"]) for r in rows(license_scan.scan(texts(data))))
    assert set(got) == {(30, "MIT"), (31, "MIT")}
    own = spark.createDataFrame([("a", "one two three four"), ("b", None), ("c", "")], "license_id string, text string")
    assert [r["doc_id"] for r in rows(license_scan.scan(texts([(1, "zero ONE two, three four five")]), own))] == [1]
    assert rows(license_scan.scan(texts([]))) == []


@pytest.mark.parametrize("offset", range(7))
def test_license_scan_finds_a_notice_wherever_it_stands(spark, texts, offset):
    filler = lambda n, s: " ".join(f"{s}{i}" for i in range(n))
    docs = [(k, f"{filler(offset + 20, 'p')} {notice} {filler(40, 'q')}")
            for k, notice in enumerate(license_scan.NOTICES.values())]
    got = {r["doc_id"] for r in rows(license_scan.scan(texts(docs)))}
    assert got == set(range(len(docs)))


def test_license_scan_of_whole_and_edited_texts_equals_brute_force(spark, texts):
    def grams(text):
        w = re.findall(r"[^\W_]+", text.lower())
        return {tuple(w[k:k + 3]) for k in range(len(w) - 2)}

    r = random.Random(8)
    held = license_scan.default_templates()
    docs = []
    for name in sorted(held):
        for every in (0, 60, 25, 14, 9):    # a word in so many is another
            w = held[name].split()
            w = [f"edit{r.randrange(99)}" if every and r.random() < 1 / every else x for x in w]
            docs.append((len(docs), "zero one two three. " * r.randrange(9) + " ".join(w) + " and more of it" * 5))
    want = {(i, k) for i, t in docs for own in [grams(t)] for k, x in held.items()
            for g in [grams(x)] if 100 * len(g & own) >= 80 * len(g)}
    got = [(r["doc_id"], r["license_id"]) for r in rows(license_scan.scan(texts(docs)))]
    assert len(got) == len(set(got)) and set(got) == want
    found = {k.partition("/")[0] for _, k in got}
    assert {"MIT", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "AGPL-3.0", "ISC", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense"} <= found
    assert {(i, k) for i, (k, e) in enumerate((k, e) for k in sorted(held) for e in range(5)) if e == 0} <= set(got)


def test_license_scan_refuses_too_many_grams(spark, texts, monkeypatch):
    monkeypatch.setattr(license_scan, "MAX_GRAMS", 100)
    with pytest.raises(ValueError, match="100 3-grams"):
        license_scan.scan(texts([]))


def test_license_scan_misses_no_short_notice(spark, texts):
    notice = license_scan.NOTICES["MIT"]
    docs = [(i, f"a{i} b{i} c{i} {notice} d{i} e{i} f{i}") for i in range(12_000)]   # a miss in 1,000 would show
    got = {r["doc_id"] for r in rows(license_scan.scan(texts(docs))) if r["license_id"] == "MIT"}
    assert got == set(range(12_000))


def test_license_scan_equals_brute_force_over_its_windows(spark, texts):
    """Templates of all lengths in texts with words changed, put in and left out."""
    r = random.Random(4)
    held = {f"t{n}": " ".join(f"w{r.randrange(300)}" for _ in range(n)) for n in (3, 4, 7, 9, 18, 19, 40, 120, 600)}
    docs = []
    for name in sorted(held):
        for _ in range(25):
            words, rate = [], r.choice((0, 0, 0.02, 0.06, 0.1))
            for w in held[name].split():
                kind = r.choice("cio") if r.random() < rate else ""
                words += {"": [w], "c": [f"x{r.randrange(99)}"], "i": [w, f"x{r.randrange(99)}"], "o": []}[kind]
            lead, tail = ([f"w{r.randrange(300)}" for _ in range(r.randrange(40))] for _ in range(2))
            docs.append((len(docs), " ".join(lead + words + tail)))
    docs.append((len(docs), " ".join(held.values())))

    def grams(text):
        w = text.split()
        return [tuple(w[k:k + 3]) for k in range(len(w) - 2)]

    want = {}
    for i, t in docs:
        own = grams(t)
        for name, x in held.items():
            n, need = len(grams(x)), set(grams(x))
            wide, step = license_scan.width(n), license_scan.stride(n)
            best = max((len(need & set(own[max(a, 0):max(a + wide, 0)])) for a in range(-(wide // step) * step, len(own), step)),
                       default=0)
            if 100 * best >= 80 * len(need):
                want[i, name] = best
    table = spark.createDataFrame(list(held.items()), "license_id string, text string")
    found = rows(license_scan.scan(texts(docs), table, in_window=True))
    assert {(o["doc_id"], o["license_id"]): o["shared"] for o in found} == want
    assert len(found) == len(want) > 150
    # the place is that of a 3-gram of the template
    text = dict(docs)
    assert all(grams(text[o["doc_id"]])[o["first_word"]] in set(grams(held[o["license_id"]])) for o in found)


def test_license_scan_settings_miss_less_than_one_in_a_million():
    assert max(license_scan.miss_estimate(n) for n in range(1, 3000)) < 1e-6
    assert all(license_scan.width(n) - n >= license_scan.stride(n) - 1 for n in range(1, 3000))


def test_license_scan_matches_repeated_rows_and_long_texts(spark, texts):
    notice = license_scan.NOTICES["MIT"]
    long = "lorem ipsum dolor " * 100_000 + notice + " sit amet" * 300_000
    got = rows(license_scan.scan(texts([(1, notice), (1, notice), (2, long), (None, notice)]), in_window=True))
    assert Counter(o["doc_id"] for o in got) == {1: 2, 2: 1, None: 1}
    assert {o["first_word"] for o in got if o["doc_id"] == 2} == {300_000}
