"""Queries behind consensus read each view once, and join counts of equal bases instead of bases."""

import pytest

from barkline import catalogue
from barkline.operators import consensus as cs
from barkline.plans import views

from oracle import assert_equal


@pytest.mark.parametrize("name", ["vcf_records", "non_reference", "family_size_track"])
def test_each_view_is_read_once(spark, monkeypatch, name):
    read, run = [], views._run
    monkeypatch.setattr(views, "_run", lambda s, d, sql, stage=True: read.append((sql, stage)) or run(s, d, sql, stage))
    sf_dir = "/root/testdata/sf0.001"
    assert_equal(catalogue.QUERIES[name](spark, sf_dir), sf_dir, catalogue.ORACLE_SQL[name])
    assert sorted(read) == sorted([(views.READS, False), (views.PILEUP, False)])


def test_bases_of_one_barcode_and_start_are_one_row(spark, monkeypatch):
    rows = [("r", 5, k, "AC", 3, "A", "A" if k % 4 else "C", 30 if k % 5 else 1) for k in range(200)] + [("r", 5, 999, "GG", 90, "A", "T", 30)]
    piled = spark.createDataFrame(rows, "region string, pos bigint, read_id bigint, umi string, start bigint, ref string, alt string, q int")
    groups = spark.createDataFrame([("r", "AC", "AC"), ("r", "GG", "AC")], "region string, umi string, parent string")
    families = spark.createDataFrame([("r", "AC", 4, 200)], "region string, parent string, fam_pos bigint, fam_n bigint")
    joined, near = [], cs.nearest_family
    monkeypatch.setattr(cs, "nearest_family", lambda bases, *rest: joined.append(bases.count()) or near(bases, *rest))
    got = {tuple(r) for r in cs.family_allele_counts(piled, groups, families, 25, 10).collect()}
    n = {alt: sum(1 for r in rows[:200] if r[6] == alt and r[7] >= 25) for alt in "AC"}
    assert got == {("r", 5, "AC", 4, 200, 1, "A", alt, n[alt]) for alt in "AC"}
    assert joined == [3]
    assert {tuple(r) for r in cs.all_alleles(cs.base_counts(piled)).collect()} == {tuple(r) for r in cs.uncollapsed_alleles(piled).collect()}
