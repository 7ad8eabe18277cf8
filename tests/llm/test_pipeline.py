import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from loomstat.llm import bpe, decontaminate, quality_rules
from loomstat.llm.queries_bpe import RANK_FILE
from loomstat.llm.queries_native import mask_documents

from tests.llm.fixtures import SCHEMA, documents, odd_texts, prose
from tests.llm.test_simhash import brute_groups


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with a case for each stage."""
    path = tmp_path_factory.mktemp("corpus")
    item = prose(500, 40)
    texts = odd_texts() + [
        (20, prose(20, 120) + " write to someone@example.org or +1 555 123 4567."),
        (21, prose(21, 60) + "\n" + item + "\n" + prose(22, 60)),
        (22, prose(23, 100) + "\nHome | About | Help | More\n" + prose(24, 60)),
        (23, "JUNK!! " * 80),
        (24, prose(25, 120)),
    ]
    documents(spark, texts).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near dedup", "decontamination", "pii", "bpe"]


def test_whole_pipeline_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [(r.doc_id, r.clean_text) for r in quality_rules.assess(docs).collect() if r.kept]
    groups = {i: least for i, _, least in brute_groups(kept) if i is not None}
    kept = [(i, t) for i, t in kept if i is None or groups[i] == i]
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    bad = {r.doc_id for r in decontaminate.find(documents(spark, kept), bench).collect()}
    assert bad == {21}
    kept = [(i, t) for i, t in kept if i not in bad]
    masked = [(r.doc_id, r.text) for r in mask_documents(documents(spark, kept)).collect()]
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted([(i, library.encode_ordinary(t), t) for i, t in masked], key=str)
    got = sorted([(r.doc_id, list(r.ids), r.text) for r in corpus_pipeline.run(spark, folder).collect()], key=str)
    assert got == want
    told = dict((i, t) for i, _, t in got)
    assert {4, 7, 20, 22, 24} <= set(told) and not {5, 6, 21, 23} & set(told)
    assert "[EMAIL]" in told[20] and "[PHONE]" in told[20] and "About" not in told[22]


@pytest.mark.parametrize("name", ["quality rules", "near dedup", "decontamination", "pii"])
def test_filters_return_the_columns_of_documents(spark, folder, name):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = stage(name)(spark, docs, folder)
    assert out.columns == docs.columns
    assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_documents(spark, folder, name):
    assert stage(name)(spark, spark.createDataFrame([], SCHEMA), folder).collect() == []


def test_clean_documents_stay(spark, folder):
    clean = documents(spark, [(i, prose(1000 + i, 80 + i)) for i in range(40)])
    out = clean
    for name in ("quality rules", "near dedup", "decontamination", "pii"):
        out = stage(name)(spark, out, folder)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted((r.doc_id, r.text) for r in clean.collect())
