"""Every numbered query on the smallest tables, against the contract in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import plain
from voxmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_token_counts(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows(spark, "op1_token_counts")}
    want = {}
    for d, r in docs.items():
        n = len(tok.encode(r.text or "", add_special_tokens=False).ids)
        want[d] = (len((r.text or "").encode()), n, n > 1024)
    assert got == want


def test_suffix_dedup(spark, docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(spark, "op2_suffix_dedup")}
    want = plain.without_repeats([(d, r.text) for d, r in docs.items()], 50)
    assert got == {d: w[:4] for d, w in want.items()}
    assert any(w[1] for w in want.values())


def test_ngram_join(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows(spark, "op3_ngram_join")}
    assert got == plain.jaccard_components([(d, r.text) for d, r in docs.items()], 4, 85)


def test_pivot_dedup(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows(spark, "op4_pivot_dedup")}
    want = plain.cosine_links([(r.vec_id, r.embedding, r.label) for r in vectors], 0.98)
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_main_text(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in rows(spark, "op5_main_text")}
    assert set(got) == set(pages)
    for i, page in pages.items():
        article = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
        text = html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", article).replace("<b>", ""))
        assert got[i].text == " ".join(text.split())
        assert got[i].n_chars == len(got[i].text)


def test_language_id(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op6_language_id")}
    assert set(got) == set(docs)
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [d for d in docs if got[d].held_out]
    assert sum(got[d].lang_pred == docs[d].lang for d in held) >= 0.95 * len(held)


def test_perplexity_rules(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op7_perplexity_rules")}
    for d, r in docs.items():
        g = got[d]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == plain.base_rules(r.text)
        assert not (g.base_failed and g.kept)
    fine = [g for g in got.values() if not g.base_failed]
    assert sum(g.kept for g in fine) > 0.9 * len(fine)


def test_packing(spark, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op8_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(docs)
    for d, r in docs.items():
        ids, at = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for p in sorted(pieces[d], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + p.length].tobytes()))
            at += p.length
        assert at == len(ids)
    padding = total = 0
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= 2048 and members[0].padded_to == (at if at & (at - 1) == 0 else 2048)
        padding, total = padding + members[0].padded_to - at, total + at
    assert padding < 0.005 * total


def test_chat_format(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    said = r"\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    want = {}
    for c, found in turns.items():
        found.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in found)
        loss = "".join(text for _, role, text in found if role == "assistant")
        want[c] = (len(found), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = rows(spark, "op9_chat_format")
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    assert all(r.formatted_chars > r.loss_chars for r in got)


def test_source_mix(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op10_source_mix")}
    size = {d: len(plain.WORD.findall(r.text or "")) for d, r in docs.items()}
    by_source = defaultdict(int)
    for d, r in docs.items():
        by_source[r.source] += size[d]
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, target = float(sum(by_source.values())), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * by_source[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        target |= {s: 3.0 * by_source[s] for s in over}
        left, free = left - sum(target[s] for s in over), free - over
    taken = defaultdict(int)
    for d, r in got.items():
        s = docs[d].source
        assert (r["size"], r.source_size) == (size[d], by_source[s]) and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 256 for s in order)
    assert {r.doc_id: r.taken for r in rows(spark, "op10_source_mix")} == {d: r.taken for d, r in got.items()}
