"""What the pipeline's operators leave in the shared folder."""

from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from tests.conftest import rows
from tidemark.llm import decontaminate, mixing, quality, simhash
from tidemark.llm.common import Scratch, table
from tidemark.sources.staging import shared_folder

SF_DIR = "/root/testdata/sf0.001"


def test_only_the_named_tables_stay(spark):
    scratch = Scratch(spark, "scratch_test")
    one, two, three = (scratch(spark.range(n), f"t{n}") for n in (1, 2, 3))
    scratch.keep_only(two)
    four = scratch(spark.range(4), "t4")
    assert two.count() == 2 and four.count() == 4
    assert sorted(p.name for p in Path(scratch.folder).iterdir()) == ["002_t2", "004_t4"]
    scratch.keep_only()
    assert list(Path(scratch.folder).iterdir()) == []


OPERATORS = {
    "quality": (lambda spark, docs, s: quality.kept(docs, table(spark, SF_DIR, "labels"), s), ["scored", "thresholds"]),
    "simhash": (lambda spark, docs, s: simhash.representatives(docs, scratch=s), ["kept"]),
    "decontaminate": (lambda spark, docs, s: decontaminate.without_contaminated(docs, table(spark, SF_DIR, "benchmark"), s), ["bad"]),
    "mixing": (lambda spark, docs, s: mixing.mixed(docs, scratch=s), ["copies"]),
}


@pytest.mark.parametrize("label", OPERATORS)
def test_a_stage_keeps_what_its_result_reads_and_no_more(spark, label):
    """The same rows with all tables kept (a caller's own scratch) and with the others removed."""
    run, left = OPERATORS[label]
    docs = table(spark, SF_DIR, "documents")
    before = set(Path(shared_folder(spark)).iterdir())
    out = run(spark, docs, None)
    (folder,) = set(Path(shared_folder(spark)).iterdir()) - before
    assert sorted(p.name.partition("_")[2] for p in folder.iterdir()) == left
    whole = Scratch(spark, "scratch_test")
    assert rows(out) == rows(run(spark, docs, whole))
    assert len(list(Path(whole.folder).iterdir())) > len(left)


def test_the_stages_are_those_operators():
    assert [n for n, _ in corpus_pipeline.STAGES][:4] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources"]
