"""The queries without SQL, digests included, against brute force over a whole table."""

import hashlib
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

from scorekit.llm.bpe import WORD_BPE
from scorekit.llm.common import table
from scorekit.llm.queries import op5_secrets, op6_bpe, op7_near_dedup, op8_mixing
from tests.llm.test_dedup import shingle_set
from tests.llm.test_texts import spans_by_hand

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "", r.source) for r in table(spark, SF_DIR, "documents").collect()]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_secrets(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smaller one has none
    docs = [(r.doc_id, r.text or "") for r in table(spark, sf_dir, "documents").collect()]
    found = {r.doc_id: r for r in op5_secrets(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    kinds = ("assign", "access", "hex")
    seen = 0
    for key, text in docs:
        spans = spans_by_hand(text)
        base = [f"{kinds[k]}:{start}:{end}" for start, k, end in spans]
        row = found[key]
        counts = Counter(k for _, k, _ in spans)
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(counts[k] for k in range(3))
        assert row.base_sha256 == sha(",".join(base))
        all_spans = row.spans.split(",") if row.spans else []
        assert [s for s in all_spans if not s.startswith("markov:")] == base
        starts = [int(s.split(":")[1]) for s in all_spans]
        assert starts == sorted(starts)
        seen += len(base)
    assert seen


def test_bpe(spark, docs):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    wanted = set()
    for key, text, _ in docs:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        wanted.add((key, len(ids), sha(data), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in op6_bpe(spark, SF_DIR).collect()} == wanted


def test_near_dedup(spark, docs):
    sets = [shingle_set(text) for _, text, _ in docs]
    own = [key for key, _, _ in docs]
    changed = True
    while changed:
        changed = False
        for i in range(len(docs)):
            for j in range(i):
                common = len(sets[i] & sets[j])
                if common and own[i] != own[j] and 100 * common >= 85 * len(sets[i] | sets[j]):
                    own[i] = own[j] = min(own[i], own[j])
                    changed = True
    wanted = {(key, len(s), c, key == c) for (key, _, _), s, c in zip(docs, sets, own)}
    assert {tuple(r) for r in op7_near_dedup(spark, SF_DIR).collect()} == wanted


def test_mixing(spark, docs):
    sizes = {key: len(re.findall(r"[^\x20\x09-\x0D]+", text)) for key, text, _ in docs}
    names = sorted({s for _, _, s in docs if s is not None}) + [None] * any(s is None for _, _, s in docs)
    of_source = {n: sum(sizes[key] for key, _, s in docs if s == n) for n in names}
    weight = {n: (1, 2, 3)[i % 3] for i, n in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(of_source.values()))
    while open_:  # fill up by weight until none is above its limit
        share = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if share * weight[n] > 3 * of_source[n]}
        for n in full or open_:
            target[n] = 3.0 * of_source[n] if full else share * weight[n]
            left -= target[n] if full else 0
        open_ = open_ - full if full else set()
    rows = op8_mixing(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(sizes)
    source = {key: s for key, _, s in docs}
    taken = Counter()
    for r in rows:
        assert r.size == sizes[r.doc_id] and r.source_size == of_source[source[r.doc_id]]
        assert abs(r.target - target[source[r.doc_id]]) < 1e-6 * max(1, r.target)
        assert r.taken % max(1, r.size) == 0 and 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    # Sources of ten documents: whole documents come no nearer than a fraction of the largest.
    largest = {n: max(sizes[key] for key, _, s in docs if s == n) for n in names}
    assert all(abs(taken[n] - target[n]) <= max(0.15 * target[n], largest[n] / 2) for n in names)
    again = op8_mixing(spark, SF_DIR).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
