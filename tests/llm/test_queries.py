"""Every operator query over the whole middle size, against brute force or SQL."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_MID
from tokenizers import Tokenizer

from tripweave.llm import queries as Q


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def token_ids(documents, tokenizer):
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in documents.items()}


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def union_find(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return find


def test_op1_equals_its_sql(spark, con):
    df = Q.op1_quality_rules(spark, SF_MID)
    res = con.execute(Q.OP1)
    columns = [d[0] for d in res.description]
    want = sorted(tuple(r) for r in res.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want


def test_op2_held_out_accuracy(spark, con):
    lang = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = Q.op2_language_id(spark, SF_MID).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r["held_out"]]
    assert all((crc(r["doc_id"]) % 4 == 2) == r["held_out"] and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_op3_finds_the_notices(spark, documents):
    from tripweave.llm.license_scan import NOTICES
    rows = {(r["doc_id"], r["license_id"]) for r in Q.op3_license_scan(spark, SF_MID).collect()}
    planted = {(i, k) for i, t in documents.items() for k, notice in NOTICES.items() if notice in (t or "")}
    assert planted and planted <= rows
    assert all(r in planted for r in rows)


def test_op4_equals_the_library(spark, tokenizer, token_ids):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: r for r in Q.op4_bpe_codec(spark, SF_MID).collect()}
    assert got.keys() == token_ids.keys()
    for i, ids in token_ids.items():
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == sha(",".join(map(str, ids)))
        assert got[i]["decoded_sha256"] == sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_op5_equals_brute_force(spark, documents):
    sets = {}
    for i, t in documents.items():
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for x in range(len(ids)):
            for y in range(x):
                shared[ids[y], ids[x]] += 1
    find = union_find((a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in Q.op5_ngram_jaccard(spark, SF_MID).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}


def test_op6_reads_back_every_turn(spark, con):
    rows = con.execute("SELECT conv_id, role, coalesce(text, '') FROM conversations ORDER BY conv_id, turn").fetchall()
    rows += [(-1, r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]
    turns = defaultdict(list)
    for c, role, text in rows:
        turns[c].append((role, text))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["conv_id"]: r for r in Q.op6_chat_format(spark, SF_MID).collect()}
    assert got.keys() == turns.keys()
    for c, t in turns.items():
        said = "".join(x for r, x in t if r == "assistant")
        assert got[c]["n_turns"] == len(t)
        assert got[c]["turns_sha256"] == sha("".join(f"{r}\n{x}\n" for r, x in t))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(said), sha(said))


def test_op7_is_a_packing(spark, token_ids):
    rows = Q.op7_best_fit_packing(spark, SF_MID).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        ids = (token_ids[r["doc_id"]] + [0])[r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(packed(ids)) == r["ids_crc32"] and 1 <= r["length"] <= 2048
    assert docs.keys() == token_ids.keys()
    for i, pieces in docs.items():
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert all(r["length"] == 2048 for r in pieces[1:])
        assert sum(r["length"] for r in pieces) == len(token_ids[i]) + 1
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(t) + 1 for t in token_ids.values())
    assert len(sequences) <= -(-total // 2048) + 2


def test_op8_reads_its_files_back(spark, token_ids):
    got = {r["doc_id"]: r for r in Q.op8_token_files(spark, SF_MID).collect()}
    at = 0
    for i in sorted(token_ids):
        ids = token_ids[i] + [0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(packed(ids)))
        at += len(ids)
    assert got.keys() == token_ids.keys()


def test_op9_leaves_clean_documents_alone(spark, con):
    toxic = dict(con.execute("SELECT doc_id, toxic FROM labels").fetchall())
    rows = Q.op9_toxicity(spark, SF_MID).collect()
    assert len(rows) == con.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert all((crc(r["doc_id"]) % 3 == 1) == r["held_out"] and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    known = [r for r in rows if r["doc_id"] in toxic]
    clean = [r for r in known if not toxic[r["doc_id"]]]
    bad = [r for r in known if toxic[r["doc_id"]]]
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    assert sum(r["predicted"] for r in bad) >= 0.6 * len(bad)


def test_op10_equals_brute_force(spark, con):
    rows = con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = np.nonzero(x @ x.T >= 0.95)
    pairs = [(ids[a], ids[b]) for a, b in zip(i, j) if a != b]
    find = union_find(pairs)
    degree = defaultdict(int)
    for a, _ in pairs:
        degree[a] += 1
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in Q.op10_embedding_dedup(spark, SF_MID).collect()}
    assert got == {int(v): (degree[v], find(v), find(v) == v) for v in ids}


def test_pipeline_keeps_one_of_each_group(spark, con, documents):
    import corpus_pipeline
    rows = corpus_pipeline.run(spark, SF_MID).collect()
    kept = {r["doc_id"] for r in rows}
    toxic = {i for i, y in con.execute("SELECT doc_id, toxic FROM labels").fetchall() if y}
    groups = defaultdict(list)
    for i, t in documents.items():
        if t and t.split():
            groups[t].append(i)
    assert all(len(kept & set(ids)) <= 1 for ids in groups.values())
    clean = {min(ids) for ids in groups.values() if not toxic & set(ids)}
    assert len(clean & kept) >= 0.8 * len(clean)
