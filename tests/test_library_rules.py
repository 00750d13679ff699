"""Guards for library-wide rules stated in the README."""

import pathlib

SRC = pathlib.Path(__file__).resolve().parents[1] / "tidemark"


def _sources():
    return {p: p.read_text() for p in SRC.rglob("*.py")}


def test_no_python_udfs_in_the_library():
    for path, text in _sources().items():
        for banned in ("F.udf", "pandas_udf", "@udf", "mapInPandas", "applyInPandas", ".rdd.map"):
            assert banned not in text, f"{banned} in {path}"


def test_no_local_checkpoints_and_no_cross_joins():
    for path, text in _sources().items():
        assert "localCheckpoint" not in text, path
        assert "crossJoin" not in text and '"cross"' not in text, path
