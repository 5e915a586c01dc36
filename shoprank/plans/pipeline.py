"""End-to-end compositions: feature matrices (X5) and the prediction flows.

Every part is keyed by ``user_id`` and already hash-partitioned on it by its
final aggregation, so the left joins onto the user table line up without
re-shuffling the parts (AQE may still broadcast a part that measures small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import enrich, features, labels, pairs
from ..plans.windows import Win
from ..schema import RetailBundle


def build_features(b: RetailBundle, order_windows: tuple[Win, ...], action_windows: tuple[Win, ...] | None = None,
                   pair_sources: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """X5 (refactored): user attributes + action, order and action-order features of every window.

    Columns follow the reference order: user columns, then for each window
    its action features, order features and action-order feature.
    ``action_windows`` defaults to ``order_windows``; ``pair_sources`` defaults
    to the bundle's action and order facts.
    """
    action_windows = action_windows or order_windows
    of = enrich.order_fact(b)
    af = enrich.action_fact(b)
    if pair_sources is None:
        pa, po = af, of
    else:
        cat = enrich.sku_category(b.sku)
        pa, po = (s.join(cat, "sku_id", "left") for s in pair_sources)
    a = features.refactored_action_features(af, action_windows)
    o = features.refactored_order_features(of, order_windows)
    ao = pairs.refactored_action_order_features(pa, po, order_windows)
    out = features.anchor(b.user, a, o, ao)
    groups = []
    for wa, wo in zip(action_windows, order_windows):
        groups.append([c for c in a.columns if c.startswith(f"{wa.label}mo_action_")])
        groups.append([c for c in o.columns if c.startswith(f"{wo.label}mo_order_")])
        groups.append([c for c in ao.columns if c.startswith(f"{wo.label}mo_action_order_")])
    return features.order_columns_like_reference(out, list(b.user.columns), groups)


def build_baseline_features(b: RetailBundle, order_windows: tuple[Win, ...], label_begin, label_end,
                            action_windows: tuple[Win, ...] | None = None, make_label: bool = True,
                            pair_sources: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """X5 (baseline): user attributes + labels (or -1 placeholders) + OM*, AM*, GM* features."""
    action_windows = action_windows or order_windows
    eo = enrich.enrich_orders(b)
    ea = enrich.enrich_actions(b)
    base = labels.build_baseline_labels(b.user, eo, label_begin, label_end) if make_label \
        else labels.inference_labels(b.user)
    o = features.baseline_order_features(eo, order_windows)
    a = features.baseline_action_features(ea, action_windows)
    pa, po = pair_sources if pair_sources is not None else (ea, eo)
    g = pairs.baseline_action_order_features(pa, po, order_windows)
    return features.anchor(base, o, a, g)
