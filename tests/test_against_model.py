"""Whole jobs on tiny random catalogues against the row-at-a-time model."""

from __future__ import annotations

import uuid

import pytest

from tests import tiny
from tests.conftest import rows
from tests.model import Model, SeveralRows
from tidemark import JPN, VNM, generic_region, sync_catalog, sync_rights
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.staging import shared_folder

SERVICES = {
    "vnm": {"str": 715, "dnl": 714},
    "jpn": {"str": 716, "dnl": 717, "rent": 718},
    "generic": {"str": 715, "dnl": 714},
}
REGIONS = {"vnm": VNM, "jpn": JPN, "generic": generic_region("KOR")}
AGENCY = {"vnm": 19862, "jpn": 20382, "generic": None}


def check(spark, kind, seed, job, expected_of):
    src, tgt = tiny.catalogue(seed)
    region = REGIONS[kind]
    model = Model(
        src, tgt, region.code, SERVICES[kind], AGENCY[kind], tiny.AS_OF, regional=kind != "generic"
    )
    try:
        expected = tiny.as_rows(expected_of(model))
    except SeveralRows:
        expected = None
    # ids 1 to 6 in three parts, so that runs touch some parts and not others
    store = Snapshots(spark, f"{shared_folder(spark)}/tiny-{uuid.uuid4().hex}", ids_per_part=3)
    store.seed(tiny.frames(spark, tgt))
    frames = tiny.frames(spark, src)
    if expected is None:
        with pytest.raises(Exception, match="(?s)match one row|more than one r"):
            job(spark, frames, store, region, tiny.AS_OF)
        return
    got = job(spark, frames, store, region, tiny.AS_OF)
    for name, want in expected.items():
        assert rows(got[name]) == want, (kind, seed, name)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("kind", REGIONS)
def test_catalog(spark, kind, seed):
    check(spark, kind, seed, sync_catalog, Model.catalog)


@pytest.mark.parametrize("seed", range(10, 12))
@pytest.mark.parametrize("kind", ["vnm", "jpn"])
def test_rights(spark, kind, seed):
    check(spark, kind, seed, sync_rights, Model.rights)


def test_catalog_fails_like_the_model(spark):
    src, tgt = tiny.catalogue(30)
    with pytest.raises(SeveralRows):
        Model(src, tgt, "VNM", SERVICES["vnm"], 19862, tiny.AS_OF).catalog()
    check(spark, "vnm", 30, sync_catalog, Model.catalog)


def test_catalog_beyond_the_broadcast_threshold(spark, no_broadcast):
    check(spark, "vnm", 2, sync_catalog, Model.catalog)
    check(spark, "generic", 3, sync_catalog, Model.catalog)
