"""Role lists, single records, single-column labels, grids."""

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from cohortlens.operators import grids, models
from cohortlens.operators.profile import numeric_columns
from cohortlens.sources import files
from cohortlens.sources.files import Roles


def test_roles_round_trip_extend_and_verify(spark, tmp_path):
    roles = Roles(["a", "b"], ["c"], "y", "id").extend(["b", "d"], ["e"])
    assert roles.features == ["a", "b", "d", "c", "e"]
    roles.save(spark, str(tmp_path / "roles"))
    assert Roles.load(spark, str(tmp_path / "roles")) == roles
    df = spark.createDataFrame([(1, 1.0, 2.0, "x", 3.0, "z")], "id long, a double, b double, c string, d double, y string")
    assert roles.verify(df) == {"missing": [], "extra": ["e"]}
    assert roles.verify(df.withColumnRenamed("d", "dd")) == {"missing": ["dd"], "extra": ["d", "e"]}
    assert numeric_columns(df, exclude=["id"]) == ["a", "b", "d"]


def test_record_in_training_order(spark):
    schema = StructType([StructField("id", LongType()), StructField("x", DoubleType()), StructField("s", StringType())])
    row = files.record_frame(spark, {"s": "t", "id": 3, "unknown": 1}, schema).first()
    assert tuple(row) == (3, None, "t")


def test_single_column_labels(spark, tmp_path):
    (tmp_path / "y.csv").write_text("outcome\nA\nB\n")
    assert sorted(r[0] for r in files.load_labels(spark, str(tmp_path / "y.csv")).collect()) == ["A", "B"]
    (tmp_path / "two.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        files.load_labels(spark, str(tmp_path / "two.csv"))


def test_sniffing_reads_the_whole_header_outside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"x;y",' + "long_name" * 20 + ',"p;q"\n1,2,3\n')
    assert files.sniff_delimiter(spark, str(tmp_path / "a.csv")) == ","
    (tmp_path / "b.csv").write_text("n" * 150 + ";b\n1;2\n")
    assert files.sniff_delimiter(spark, str(tmp_path / "b.csv")) == ";"


def test_grids(spark):
    sizes = {name: len(grids.candidates(g)) for name, g in grids.GRIDS.items()}
    assert sizes["Decision Tree"] == 90 and sizes["Logistic Regression"] == 8 and sizes["KNN"] == 20
    assert sizes["Random Forest"] == 216 and sizes["Gradient Boosting"] == 108
    assert len(grids.param_maps(models.decision_tree(), grids.DECISION_TREE)) == 30  # no min_samples_split in Spark
    assert len(grids.param_maps(models.logistic(), grids.LOGISTIC_REGRESSION, rows=100)) == 4


def test_depth_beyond_the_limit_is_refused(spark):
    with pytest.raises(ValueError):
        models.decision_tree(max_depth=31)


def test_checkpoint_folder_needed_beyond_local(monkeypatch):
    from cohortlens.session import checkpoint_dir

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())
