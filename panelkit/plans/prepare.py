"""From raw indicator files to a clean, split panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from panelkit.operators.impute import impute_sequential, impute_window_median
from panelkit.operators.quality import coverage_filter, whitelist_entities
from panelkit.operators.reshape import drop_null_rows, fold_outer_join, recode
from panelkit.operators.temporal import recombine, split_at
from panelkit.runtime import stored
from panelkit.sources.files import LongFile, load_long, load_registry
from panelkit.sources.lookups import INDICATOR_FILES, NAME_RECODES, allowed_entities
from panelkit.sources.sinks import write_splits
from panelkit.spec import YEAR_MAX, YEAR_MIN, PanelSpec


@dataclass
class PreparedPanel:
    """The clean panel and its two parts; features and target are columns of each."""

    spec: PanelSpec
    train: DataFrame
    test: DataFrame

    @property
    def full(self) -> DataFrame:
        return recombine(self.train, self.test)


def clean_panel(
    frames: Sequence[DataFrame],
    spec: PanelSpec,
    allowed: DataFrame | None,
    recodes: Mapping[str, str] = NAME_RECODES,
    sequential: bool = False,
    fit_until: int | None = None,
) -> tuple[DataFrame, PanelSpec]:
    """Join, recode, filter and impute indicators.

    Names are recoded before the join, so spellings of one entity meet. A period outside
    the spec's bounds raises. With ``fit_until`` the overall medians come from periods up to it only.
    """
    recoded = [recode(f, spec.entity, recodes) for f in frames]
    panel = fold_outer_join(recoded, spec)
    if spec.target not in panel.columns:
        raise ValueError(f"no indicator gives the target {spec.target}")
    panel = drop_null_rows(panel, [spec.entity, spec.time, spec.target])
    panel = panel.withColumn(spec.time, spec.checked_time())
    if not spec.features:
        spec = spec.infer_features(panel)
    if allowed is not None:
        panel = whitelist_entities(panel, spec, allowed)
    panel = coverage_filter(stored(panel), spec)  # read again by each of the next steps
    if sequential:
        return impute_sequential(panel, spec), spec
    fit_on = None if fit_until is None else split_at(panel, spec, fit_until)[0]
    return impute_window_median(panel, spec, fit_on=fit_on), spec


def prepare_panel(
    spark: SparkSession,
    folder: str,
    target: str = "political_stability",
    train_end: int = 2017,
    files: Mapping[str, str] = INDICATOR_FILES,
    extra: Sequence[DataFrame] = (),
    allowed: DataFrame | None = None,
    output: str | None = None,
    sequential: bool = False,
    fit_until: int | None = None,
    long_files: Mapping[str, LongFile] | None = None,
) -> PreparedPanel:
    """Load ``folder``, clean the panel, split it and write it if asked to.

    ``long_files`` names indicators that are series of long files in the folder; one that is
    not there is skipped. ``extra`` takes further indicators, as tables.
    With ``fit_until`` the overall medians come from periods up to it only.
    """
    spec = PanelSpec(target=target, code="code", period_bounds=(YEAR_MIN, YEAR_MAX))
    series = [load_long(spark, folder, name, source, spec) for name, source in (long_files or {}).items()]
    frames = [*load_registry(spark, folder, files, spec), *(f for f in series if f is not None), *extra]
    if not any("code" in f.columns for f in frames):
        spec = PanelSpec(target=target, period_bounds=spec.period_bounds)
    whitelist = allowed if allowed is not None else allowed_entities(spark, spec.entity)
    panel, spec = clean_panel(frames, spec, whitelist, sequential=sequential, fit_until=fit_until)
    if output is not None:
        write_splits(panel, spec, train_end, output)
        panel = spark.read.parquet(output).drop("split")
    train, test = split_at(panel, spec, train_end)
    return PreparedPanel(spec, train, test)
