"""Rule segments and micro-segments from customer features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.operators import centroids as M
from cartwright.operators import segments as S
from cartwright.operators.fitting import fit_models
from cartwright.session import written


@dataclass(frozen=True)
class SegmentSpec:
    """Columns, renames and micro plans of a segmentation."""

    keep: tuple[str, ...]
    flags: tuple[str, ...]
    renames: Mapping[str, str]
    micro_renames: Mapping[str, str] = field(default_factory=dict)
    plans: tuple[M.MicroPlan, ...] = ()


def segment_base(features: DataFrame, spec: SegmentSpec) -> DataFrame:
    """Features in the domain of the rules, limited to the configured columns."""
    return S.keep_existing(S.in_domain(features), [*spec.keep, *spec.flags])


def flagged(base: DataFrame, spec: SegmentSpec) -> DataFrame:
    return S.flag_features(base, spec.flags, spec.renames)


def rule_segments(features: DataFrame, spec: SegmentSpec) -> DataFrame:
    """(customer, Segment), one row per customer."""
    return S.assign_segments(flagged(segment_base(features, spec), spec))


def segments_with_features(features: DataFrame, spec: SegmentSpec) -> DataFrame:
    return S.with_segment(segment_base(features, spec), spec.flags, spec.renames)


Models = DataFrame | Mapping[str, M.CentroidModel]


def planned_customers(features: DataFrame, spec: SegmentSpec) -> DataFrame:
    """Customers with their segment, where an enabled plan takes it: no other row reaches a score or a quantile."""
    sources = sorted({s for p in spec.plans if p.enabled for s in p.source_segments})
    return segments_with_features(features, spec).where(F.col("Segment").isin(sources))


def micro_segments(features: DataFrame, spec: SegmentSpec, models: Models, write_once: bool = True) -> DataFrame:
    """Micro-segments of all plans next to the base features.

    Customer features hold one row per customer, so the segment is computed on
    the row itself and neither the assignments nor the features are joined back. Capped plans read
    the rows three times, so they are written once, unless ``features`` is a written table already.
    """
    segmented = planned_customers(features, spec)
    if write_once and any(p.enabled and p.capped for p in spec.plans):
        segmented = written(segmented, "segmented")
    return M.micro_segments(segmented, spec.plans, models, spec.micro_renames)


def fitted_models(features: DataFrame, spec: SegmentSpec, wanted: Mapping[str, Sequence[str]], clusters: int = 4, seed: int = 1,
                  rounds: int = 20) -> DataFrame:
    """A model table for the enabled plans, fitted on the customers that each plan would score.

    ``wanted`` names the features of every model key.
    """
    segmented = written(planned_customers(features, spec), "segmented")
    return fit_models(segmented, spec.plans, wanted, spec.micro_renames, clusters, seed, rounds)


def micro_segments_from_assignments(
    base: DataFrame, assignments: DataFrame, spec: SegmentSpec, models: Models
) -> DataFrame:
    """The same from stored assignments, by a join on the customer id."""
    return M.micro_segments(M.attach_assignments(base, assignments), spec.plans, models, spec.micro_renames)
