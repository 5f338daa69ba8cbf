"""Report job (B1): read the inputs, build one report, gate it, write it.

Order of work, chosen so a failure leaves the previous output untouched and so the report's
plan runs once:

1. read inputs with declared types (CSV files once, into staged columns that are deleted after
   step 3); a value that does not fit raises before anything is built;
2. build the report plan;
3. write the result to the session's shared scratch folder: later steps read the written rows,
   and a lost executor costs a re-read, not a re-run of the plan;
4. gates: one aggregate for emptiness and all bad-row predicates, one grouped scan per key
   list; any failure raises ``GateError`` before anything is written to the output;
5. presentation (money as text) and the write, one file where the report's parameters bound its
   rows; then the staged rows are deleted.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from dialstat.operators.quality import GateError, check
from dialstat.plans.reports import REPORTS
from dialstat.session import delete_path, shared_scratch_path
from dialstat.sources.export import write_result
from dialstat.sources.tables import CALLS_COLUMNS, PEOPLE_COLUMNS, SALES_COLUMNS, read_table

log = logging.getLogger(__name__)

INPUT_COLUMNS = {"calls": CALLS_COLUMNS, "people": PEOPLE_COLUMNS, "sales": SALES_COLUMNS}


class ReportsError(GateError):
    """One or more reports of a run failed; ``errors`` has each report's own exception and
    ``results`` the reports that went well."""

    def __init__(self, errors: Mapping[str, Exception], results: Mapping[str, DataFrame]):
        super().__init__("; ".join(f"{name}: {err}" if name not in str(err) else str(err) for name, err in errors.items()))
        self.errors, self.results = dict(errors), dict(results)


def load_inputs(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame | str],
    formats: Mapping[str, str] | None = None,
    scratch: list[str] | None = None,
) -> dict[str, DataFrame]:
    """The named report inputs (``calls``, ``people``, ``sales``): paths are read from CSV or
    parquet with declared types, DataFrames are used as given.

    :param formats: ``csv`` or ``parquet`` by input name, where the files' names do not tell
    :param scratch: gets the paths of staged copies
    """
    return {
        name: read_table(spark, value, INPUT_COLUMNS[name], (formats or {}).get(name), scratch=scratch)
        if isinstance(value, str)
        else value
        for name, value in inputs.items()
    }


def run_report(
    spark: SparkSession,
    name: str,
    inputs: Mapping[str, DataFrame | str],
    output: str | None = None,
    params: Mapping[str, object] | None = None,
    write: bool = True,
    single_file: bool | None = None,
    formats: Mapping[str, str] | None = None,
) -> DataFrame:
    """Build, gate and (optionally) write one report.

    :param name: a key of ``REPORTS``
    :param inputs: the report's input tables, as DataFrames or paths
    :param output: output folder (overwritten); required when ``write``
    :param params: report parameters, e.g. ``{"n": 3, "threshold": 75}``
    :param write: ``False`` is a dry run: build and gate only
    :param single_file: ``False`` writes a bounded report in parallel; ``True`` is refused for a
        report whose rows grow with its input
    :param formats: see ``load_inputs``
    :return: the presented result: the written files, or for a dry run the staged rows (which
        stay until ``release_scratch``)
    """
    report = REPORTS[name]
    merged = {**report.defaults, **(params or {})}
    unknown = set(merged) - set(report.defaults)
    if unknown:
        raise ValueError(f"{name}: unknown parameters {sorted(unknown)}")
    missing = [key for key in report.inputs if key not in inputs]
    if missing:
        raise ValueError(f"{name}: inputs {missing} missing")
    if write and not output:
        raise ValueError("output folder required when write=True")
    if single_file and not report.single_file:
        raise ValueError(f"{name}: its rows grow with the input; it is not written as one file")
    copies: list[str] = []
    staged = shared_scratch_path(spark, f"report-{name}")
    try:
        tables = load_inputs(spark, {key: inputs[key] for key in report.inputs}, formats, copies)
        built = report.build(**tables, **merged)
        built.write.parquet(staged)
    finally:
        for path in copies:
            delete_path(spark, path)
    result = spark.read.schema(built.schema).parquet(staged)
    try:
        counts = check(result, report.gate(merged), what=name)
    except GateError:
        delete_path(spark, staged)
        raise
    log.info("%s: %d rows passed the gates", name, counts["rows"])

    final = report.present(result) if report.present else result
    if not write:
        return final
    one_file = report.single_file if single_file is None else single_file
    write_result(final, output, single_file=one_file, order=report.order)
    delete_path(spark, staged)
    log.info("%s: written to %s", name, output)
    return spark.read.option("header", True).schema(final.schema).csv(output)  # what was just written


def run_reports(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame | str],
    output_root: str | None,
    names: list[str] | None = None,
    params: Mapping[str, Mapping[str, object]] | None = None,
    write: bool = True,
    formats: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Run several reports over the same inputs, each into ``<output_root>/<report folder>``
    (``it_data``, ``marketing_address_info``, ``department_breakdown``, ``top_3``,
    ``top_3_most_sold_per_department_netherlands``, ``best_salesperson``).

    Each report is gated and written on its own: whatever stops one report, the others run, and
    the failures are raised together at the end as ``ReportsError``.
    """
    copies: list[str] = []
    loaded = load_inputs(spark, inputs, formats, copies)
    results: dict[str, DataFrame] = {}
    errors: dict[str, Exception] = {}
    for name in names or list(REPORTS):
        report = REPORTS[name]
        output = f"{output_root.rstrip('/')}/{report.output}" if output_root else None
        try:
            results[name] = run_report(
                spark, name, loaded, output, (params or {}).get(name), write=write
            )
        except Exception as err:  # kept and raised below, with the other reports' errors
            log.error("%s: %s", name, err)
            errors[name] = err
    for path in copies:
        delete_path(spark, path)
    if errors:
        raise ReportsError(errors, results)
    return results
