from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from scorekit.llm.bpe import WORD_BPE
from scorekit.llm.common import table
from scorekit.llm.exact_dedup import exact_groups
from scorekit.llm.mixing import draw_copies
from tests.llm.corpus import documents
from tests.llm.test_dedup import plain, shingle_set

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and after each stage, with each of them read from Parquet."""
    folder = tmp_path_factory.mktemp("stages")
    docs = table(spark, SF_DIR, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        found.append(docs)
    return found


def test_the_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mixing", "bpe"]


def test_all_but_the_last_keep_the_columns(stages):
    assert all(docs.dtypes == stages[0].dtypes for docs in stages[:-1])
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids"]


def test_toxicity_drops_the_toxic(spark, stages):
    labels = {r.doc_id: r.toxic for r in table(spark, SF_DIR, "labels").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    toxic = [i for i, t in labels.items() if t]
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)
    assert sum(i in kept for i in toxic) <= 0.5 * len(toxic)


def test_exact_dedup_leaves_one_of_each_text(stages):
    before, after = ([plain(r.text) for r in s.collect()] for s in stages[1:3])
    assert sorted(after) == sorted(set(before))
    keep = {r.keep_id for r in exact_groups(stages[1]).collect()}
    assert {r.doc_id for r in stages[2].collect()} == keep


def test_near_dedup_leaves_one_of_each_group(stages):
    rows = sorted(stages[2].collect(), key=lambda r: r.doc_id)
    sets = [shingle_set(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert {r.doc_id for r in stages[3].collect()} == {rows[find(i)].doc_id for i in range(len(rows))}
    assert stages[3].count() == len({find(i) for i in range(len(rows))})


def test_mixing_takes_the_drawn_copies(stages):
    drawn = {r.doc_id: r.copies for r in draw_copies(stages[3]).collect() if r.copies}
    assert Counter(r.doc_id for r in stages[4].collect()) == Counter(drawn)


def test_bpe_encodes_what_is_left(stages):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    expected = Counter()
    for r in stages[4].collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        expected[r.doc_id, len(ids), b"".join(i.to_bytes(4, "little") for i in ids)] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in stages[5].collect()) == expected


def test_stages_take_an_empty_table_and_other_columns(spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), SF_DIR).collect() == []
        if name != "bpe":
            docs = documents(spark)
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns and out.count() > 0
            # Every row that comes out is one that went in, in all its columns.
            rows = {tuple(r) for r in out.collect()}
            assert rows and rows <= {tuple(r) for r in docs.collect()}
