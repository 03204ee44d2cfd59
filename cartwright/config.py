"""Job configuration, read from the two JSON files users already have."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from cartwright import names as N
from cartwright.operators.centroids import MicroPlan
from cartwright.plans.order_features import OrderWindow
from cartwright.plans.segmentation import SegmentSpec


@dataclass(frozen=True)
class DeliveryChannel:
    orders_path: str
    order_columns: tuple[str, ...]
    items_path: str
    item_columns: tuple[str, ...]
    output_path: str
    complaints_path: str | None = None


@dataclass(frozen=True)
class InstoreChannel:
    orders_pattern: str
    items_pattern: str
    output_path: str


@dataclass(frozen=True)
class FeatureConfig:
    delivery: Mapping[str, DeliveryChannel]
    instore: InstoreChannel
    window: OrderWindow
    customer_map_path: str
    store_map_path: str
    store_master_path: str
    categories_path: str
    combos_path: str
    bins: tuple[float, ...]
    buckets: tuple[str, ...]
    cutoff: date
    reference: date
    customer_output_path: str
    by_month: bool = False

    @staticmethod
    def from_dict(raw: Mapping) -> "FeatureConfig":
        common, customer, instore = raw["common"], raw["customer"], raw[N.INSTORE]
        prices = common.get("price_config", {})
        bins = tuple(prices.get("price_bins", N.PRICE_BINS))
        buckets = tuple(prices.get("bucket_labels", N.BUCKET_LABELS))
        if len(bins) != len(buckets) + 1 or list(bins) != sorted(set(bins)):
            raise ValueError("price_bins must rise strictly and number one more than bucket_labels")
        run_date = date.fromisoformat(common["current_run_date"])
        reference = customer.get("reference_date")
        return FeatureConfig(
            delivery={c: _delivery(raw[c]) for c in (N.OWNAPP, N.SWIGGY)},
            instore=InstoreChannel(
                instore["orders_file_pattern"],
                instore["order_items_file_pattern"],
                instore.get("output_path") or instore["orders_output_path"],
            ),
            window=OrderWindow(
                run_date,
                int(common["months_offset"]),
                common["timezone"],
                common.get("test_store_code", OrderWindow.test_store),
            ),
            customer_map_path=common["mapping_file"],
            store_map_path=common["store_mds_dsr_path"],
            store_master_path=common["store_master_path"],
            categories_path=common["categories_path"],
            combos_path=common["clear_master_path"],
            bins=bins,
            buckets=buckets,
            cutoff=date.fromisoformat(customer.get("cutoff_date", "2024-07-01")),
            reference=date.fromisoformat(reference) if reference else run_date - timedelta(days=1),
            customer_output_path=customer["output_path"],
            by_month=bool(common.get("order_features_by_month", False)),
        )

    @staticmethod
    def load(path: str) -> "FeatureConfig":
        return FeatureConfig.from_dict(_json(path))


def _delivery(raw: Mapping) -> DeliveryChannel:
    feed = raw.get("orderqueries_path") if raw.get("has_query", False) else None
    return DeliveryChannel(
        raw["orders_data_path"], tuple(raw["orders_columns"]),
        raw["order_items_data_path"], tuple(raw["order_items_columns"]),
        raw["output_path"], feed or None,
    )


@dataclass(frozen=True)
class SegmentConfig:
    spec: SegmentSpec
    input_path: str | None
    segments_path: str
    micro_path: str
    model_paths: Mapping[str, str]

    @staticmethod
    def from_dict(raw: Mapping) -> "SegmentConfig":
        plans = micro_plans(raw.get("micro_plan", []), raw)
        spec = SegmentSpec(
            tuple(raw.get("cols_to_keep", ())),
            tuple(raw.get("convert_to_flag", ())),
            dict(raw.get("rename_dict", {})),
            dict(raw.get("rename_dict_microsegments", {})),
            plans,
        )
        paths = {p.model_key: raw[p.model_key] for p in plans}
        return SegmentConfig(
            spec, raw.get("input_path"), raw["output_segments_path"],
            raw["output_microsegments_path"], paths,
        )

    @staticmethod
    def load(path: str) -> "SegmentConfig":
        return SegmentConfig.from_dict(_json(path))


def micro_plans(items: Sequence[Mapping], models: Mapping) -> tuple[MicroPlan, ...]:
    """Checked micro plans; every model key needs an entry in ``models``."""
    plans = []
    for i, item in enumerate(items):
        name, segments, key = (item.get(k) for k in ("name", "source_segments", "model_key"))
        where = f"plan {i + 1} ({name or 'unnamed'})"
        if name is None or key is None or segments is None:
            raise ValueError(f"{where} needs a name, source_segments and a model_key")
        if isinstance(segments, str) or len(segments) == 0:
            raise ValueError(f"{where} lists no source segments")
        if key not in models:
            raise KeyError(f"{where} uses model {key}, which models does not name")
        plans.append(
            MicroPlan(item["name"], tuple(segments), item["model_key"], bool(item.get("enabled", True)))
        )
    return tuple(plans)


def _json(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)
