"""Replacement of targets in two phases, broken off at every step."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from igarape import jobs
from igarape.operators.lookup import require_all_found
from igarape.session import intermediate, scratch_path, shared_folder
from igarape.sinks import replace
from igarape.sinks.replace import Replacement, read_target, recover
from igarape.sinks.tables import export_csv, replace_table, replace_touched_partitions
from tests.conftest import MUNICIPALITIES


class Killed(BaseException):
    pass


def dying(after):
    """File operations of a process that dies after so many changes."""

    class Files(replace._Files):
        left = after

        def _spend(self):
            Files.left -= 1
            if Files.left < 0:
                raise Killed

        def rename(self, *paths):
            self._spend()
            super().rename(*paths)

        def delete(self, path):
            self._spend()
            super().delete(path)

        def write(self, *what):
            self._spend()
            super().write(*what)

    return Files


def rows(spark, version):
    return spark.range(6).select("id", F.lit(version).alias("v"), (F.col("id") % 3).alias("k"))


def versions(spark, path):
    return {r.v for r in read_target(spark, path).select("v").collect()}


def hidden(folder):
    return [p.name for p in folder.rglob("*") if "_igarape" in p.name]


def replace_all(spark, folder, version):
    with Replacement(spark) as targets:
        written = targets.table(rows(spark, version), f"{folder}/a/whole", unique=["id"])
        targets.partitions(written.filter("k < 2"), f"{folder}/parts", ["k"])
        targets.table(rows(spark, version), f"{folder}/new{version}")


def test_killed_at_any_step_leaves_one_version_everywhere(spark, tmp_path, monkeypatch):
    old = tmp_path / "old"
    replace_all(spark, old, 1)
    replace_touched_partitions(rows(spark, 1), f"{old}/parts", ["k"])
    kinds = set()
    for n in range(60):
        folder = tmp_path / str(n)
        shutil.copytree(old, folder)
        monkeypatch.setattr(replace, "_Files", dying(n))
        try:
            replace_all(spark, folder, 2)
            ended = True
        except Killed:
            ended = False
        monkeypatch.undo()
        (version,) = versions(spark, f"{folder}/a/whole")
        parts = {(r.k, r.v) for r in read_target(spark, f"{folder}/parts").select("k", "v").collect()}
        assert parts == {(0, version), (1, version), (2, 1)}
        recover(spark, f"{folder}/new2")
        assert (folder / "new2").exists() == (version == 2)
        assert not [h for h in hidden(folder) if "swap" in h or "main" in h]
        kinds.add((version, ended))
        if ended:
            assert not hidden(folder)
            break
    assert kinds == {(1, False), (2, False), (2, True)}
    replace_all(spark, tmp_path / "3", 3)
    assert versions(spark, f"{tmp_path}/3/a/whole") == {3}


def test_a_failed_rename_is_rolled_back(spark, tmp_path, monkeypatch):
    replace_all(spark, tmp_path, 1)
    real, count = replace._Files.rename, []

    def failing(self, source, target):
        count.append(source)
        if len(count) == 4:
            raise OSError("no")
        real(self, source, target)

    monkeypatch.setattr(replace._Files, "rename", failing)
    with pytest.raises(OSError):
        replace_all(spark, tmp_path, 2)
    monkeypatch.undo()
    assert versions(spark, f"{tmp_path}/a/whole") == versions(spark, f"{tmp_path}/parts") == {1}
    assert not hidden(tmp_path) and not (tmp_path / "new2").exists()


def test_checks_leave_all_targets(spark, tmp_path):
    path, table = f"{tmp_path}/t", rows(spark, 1)
    replace_table(table, path)
    export_csv(table, f"{tmp_path}/c")
    before = sorted(str(p) for p in tmp_path.rglob("*"))
    for bad, what, match in [
        (table.filter("false"), {}, "no rows"),
        (table.limit(0), {"what": "nothing came"}, "nothing came"),
        (table.union(table), {"unique": ["id"]}, "several rows"),
        (table.withColumn("id", F.when(F.col("id") > 2, F.col("id"))), {"unique": ["id"]}, "without id"),
        (table.withColumn("k", F.when(F.col("id") > 2, F.col("id"))), {"keys": ["k"]}, "without k"),
    ]:
        with pytest.raises(ValueError, match=match), Replacement(spark) as targets:
            targets.csv(table.limit(1), f"{tmp_path}/c")
            targets.table(bad, path, **what)
    with pytest.raises(ValueError, match="no rows"):
        export_csv(table.filter("id > 100"), f"{tmp_path}/c")
    assert sorted(str(p) for p in tmp_path.rglob("*")) == before and versions(spark, path) == {1}
    export_csv(table.filter("id > 100"), f"{tmp_path}/c", may_be_empty=True)
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").count() == 0


def test_partitions_with_other_columns_are_refused(spark, tmp_path):
    replace_touched_partitions(rows(spark, 1), f"{tmp_path}/t", ["k"])
    with pytest.raises(ValueError, match="differ: extra"):
        replace_touched_partitions(rows(spark, 2).withColumn("extra", F.lit(1)), f"{tmp_path}/t", ["k"])
    two = rows(spark, 2).withColumn("j", F.col("id") % 2).filter("k = 0")
    replace_touched_partitions(rows(spark, 1).withColumn("j", F.col("id") % 2), f"{tmp_path}/u", ["k", "j"])
    replace_touched_partitions(two, f"{tmp_path}/u", ["k", "j"])
    found = {(r.k, r.j, r.v) for r in read_target(spark, f"{tmp_path}/u").collect()}
    assert found == {(0, 0, 2), (0, 1, 2), (1, 0, 1), (1, 1, 1), (2, 0, 1), (2, 1, 1)}


def test_a_job_reads_what_it_replaces(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_table(rows(spark, 1), path)
    replace_table(read_target(spark, path).withColumn("v", F.col("v") + 1), path)
    assert versions(spark, path) == {2}


def test_empty_gold_leaves_the_analysis(spark, tmp_path):
    (tmp_path / "m.csv").write_text(MUNICIPALITIES, encoding="utf-8")
    gold = spark.range(1).select(F.lit("1501402").alias("cod_mun"), F.lit("x").alias("municipio"), F.lit(2020).alias("ano"))
    old = gold.withColumn("v", F.lit(1))
    replace_table(old, f"{tmp_path}/out/analysis.parquet")
    export_csv(old, f"{tmp_path}/out/priority_panel.csv")
    columns = {c: F.lit(None).cast("double") for c in ("populacao", "internacoes_total", "internacoes_hidricas", "chuva_total_mm")}
    from igarape.constants import IMPUTED_COLUMNS, PRIORITY_PANEL_COLUMNS, RANKING_COLUMNS

    needed = {*IMPUTED_COLUMNS, *PRIORITY_PANEL_COLUMNS, *RANKING_COLUMNS} - set(gold.columns)
    replace_table(gold.withColumns({c: F.lit(None).cast("double") for c in needed} | columns), f"{tmp_path}/gold.parquet")
    spark.read.parquet(f"{tmp_path}/gold.parquet").filter("false").write.parquet(f"{tmp_path}/empty.parquet")
    before = sorted((str(p), p.stat().st_mtime_ns) for p in (tmp_path / "out").rglob("*") if p.is_file())
    with pytest.raises(ValueError, match="gold table is empty"):
        jobs.run_analysis(spark, f"{tmp_path}/empty.parquet", f"{tmp_path}/m.csv", f"{tmp_path}/out")
    with pytest.raises(Exception):
        jobs.run_models(spark, f"{tmp_path}/empty.parquet", f"{tmp_path}/out")
    assert sorted((str(p), p.stat().st_mtime_ns) for p in (tmp_path / "out").rglob("*") if p.is_file()) == before


def test_intermediate_tables_go_with_the_job(spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with pytest.raises(RuntimeError), intermediate(spark):
        spark.range(3).write.parquet(scratch_path(spark))
        assert len(os.listdir(folder)) == len(before) + 1
        raise RuntimeError
    assert set(os.listdir(folder)) == before


def test_unmatched_codes_outlive_the_application(spark, dimension, tmp_path):
    codes = spark.range(3000).selectExpr("cast(id + 2000000 as string) AS cod_mun", "concat('f', id % 3) AS fonte_arquivo")
    with pytest.raises(ValueError, match=f"3000 codes .* all in {tmp_path}/unmatched: 2000000, "):
        require_all_found(codes.union(codes), dimension, "cod_mun", f"{tmp_path}/unmatched")
    found = spark.read.parquet(f"{tmp_path}/unmatched")
    assert found.count() == 3000 and found.first().asDict() == {"cod_mun": "2000000", "rows": 2, "fonte_arquivo": "f0"}
    with pytest.raises(ValueError) as error:
        require_all_found(codes.limit(1), dimension, "cod_mun")
    place = str(error.value).split("all in ")[1].rsplit(":", 1)[0]
    assert not place.startswith(shared_folder(spark)) and spark.read.parquet(place).count() == 1
