"""The stage chain as one lazy plan per dataset:

raw -> Residential + keep-list -> rate join -> typed -> flagged -> clean view
-> metrics -> district join -> IQR flags

Each stage is a ``DataFrame -> DataFrame`` transform; ``Stages`` only wires
them to a source. In a production run the boundaries that the reference
persisted (flagged, enriched, IQR-flagged) are written with
``session.stage_table`` so a lost executor never replays the whole chain.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from parcelflow import config as C
from parcelflow.operators import metrics, outliers, quality, rates, shape, spatial
from parcelflow.plans import standin
from parcelflow.session import cut_lineage

# Registered queries pin the run-date-dependent bound (G15) so results do not
# drift with the calendar.
REGISTRY_PARAMS = C.Params(next_year=2027)


@dataclass
class Stages:
    spark: SparkSession
    sf_dir: str
    dataset: str = "sold"
    params: C.Params = field(default_factory=lambda: REGISTRY_PARAMS)
    #: The stage that is read from a table, if one is.
    table: str = ""

    def __post_init__(self) -> None:
        # the wide stages are beyond what HotSpot compiles as one method (session.py)
        self.spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")

    def staged(self, stage: str, *columns: str) -> Stages:
        """These stages with ``columns`` of one stage written to a table, which the
        stages after it read: a query of several passes or branches runs the joins of
        its input once. Without names all columns are kept."""
        out = replace(self, table=stage)
        df = getattr(self, stage)
        setattr(out, stage, cut_lineage(df.select(*dict.fromkeys(columns or df.columns))))
        return out

    def flaggable(self, *columns: str) -> Stages:
        """``staged`` on the clean rows, with the fields that fences are taken of and flag."""
        return self.staged("metrics", *C.IQR_FIELDS, *columns)

    @cached_property
    def raw(self) -> DataFrame:
        if self.dataset == "sold":
            return standin.sold(self.spark, self.sf_dir)
        return standin.listings(self.spark, self.sf_dir)

    @cached_property
    def residential(self) -> DataFrame:
        return shape.residential(self.raw)

    @cached_property
    def reduced(self) -> DataFrame:
        return shape.residential_reduced(self.residential, self.dataset)

    @cached_property
    def weekly(self) -> DataFrame:
        return standin.weekly_rates(self.spark, self.sf_dir)

    @cached_property
    def monthly(self) -> DataFrame:
        return rates.monthly_rates(self.weekly)

    @cached_property
    def rated(self) -> DataFrame:
        return rates.rate_join(self.reduced, self.monthly, C.JOIN_KEYS[self.dataset])

    @cached_property
    def typed(self) -> DataFrame:
        return quality.type_convert(self.rated)

    @cached_property
    def flagged(self) -> DataFrame:
        return quality.add_flags(self.typed, self.params)

    @cached_property
    def clean(self) -> DataFrame:
        return quality.clean_view(self.flagged)

    @cached_property
    def metrics(self) -> DataFrame:
        return metrics.engineer_metrics(self.clean)

    @cached_property
    def market_stage(self) -> DataFrame:
        """The clean rows' columns of the monthly medians, which read them in
        several passes; neither districts nor fences are needed for them."""
        return cut_lineage(self.metrics.select("CloseDate", "ClosePrice", "rate_30yr_fixed", *C.FILTER_DIMS))

    @cached_property
    def boundaries(self) -> DataFrame:
        return spatial.polygons_from_vertices(standin.district_vertices(self.spark, self.sf_dir))

    @cached_property
    def polygons(self) -> DataFrame:
        return spatial.unified(self.boundaries)

    @cached_property
    def enriched(self) -> DataFrame:
        return spatial.district_join(self.metrics, self.polygons, self.params)

    @cached_property
    def enriched_counted(self) -> DataFrame:
        return spatial.district_join(self.metrics, self.polygons, self.params, keep_match_count=True)

    @cached_property
    def fences(self) -> DataFrame:
        """Of the clean rows, which need no district for them."""
        return outliers.iqr_fences(self.metrics, probs=[], accuracy=self.params.quantile_accuracy, minimal=True,
                                   staged=self.table in ("flagged", "metrics"))

    @cached_property
    def iqr_core(self) -> DataFrame:
        """The IQR-flagged rows without the districts."""
        return outliers.iqr_flags(self.metrics, fences=self.fences)

    @cached_property
    def iqr(self) -> DataFrame:
        return outliers.iqr_flags(self.enriched, fences=self.fences)


def sold(spark: SparkSession, sf_dir: str) -> Stages:
    return Stages(spark, sf_dir, "sold")


def listings(spark: SparkSession, sf_dir: str) -> Stages:
    return Stages(spark, sf_dir, "listings")
