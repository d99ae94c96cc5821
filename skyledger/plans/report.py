"""The analysis report: every analysis exported as CSV from one pass over the flights."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyledger.operators.analytics import analysis_cube, cube_results
from skyledger.sinks.files import export_csv
from skyledger.storage import materialise


def report_results(flights: DataFrame) -> dict[str, DataFrame]:
    """The profile and the six analyses. The cube (a few thousand rows, whatever the input) is
    written once; all results read it."""
    return cube_results(materialise(analysis_cube(flights), "analysis-cube"))


def write_report(flights: DataFrame, folder: str) -> dict[str, object]:
    """Export the six analyses as ``<folder>/<name>.csv``; returns the profile and the paths."""
    results = report_results(flights)
    info = results.pop("table_info")
    paths = {}
    for name, result in results.items():
        paths[name] = f"{folder.rstrip('/')}/{name}.csv"
        export_csv(result, paths[name], single_file=True)
    return {"table_info": info.first().asDict(), "outputs": paths}
