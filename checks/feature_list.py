"""

Nothing here is imported from the library: a wrong name, aggregate, column,
group or date on either side shows up as a difference.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple


class Window(NamedTuple):
    label: str
    begin: date
    end: date


class Feature(NamedTuple):
    name: str
    kind: str
    col: str | None
    where: str
    win: str


ORDER_WINDOWS = (
    Window("1", date(2001, 1, 1), date(2001, 1, 31)),
    Window("3", date(2000, 11, 1), date(2001, 1, 31)),
    Window("6", date(2000, 8, 1), date(2001, 1, 31)),
)
ACTION_WINDOWS = (
    Window("1", date(2024, 1, 24), date(2024, 1, 30)),
    Window("3", date(2024, 1, 15), date(2024, 1, 30)),
    Window("6", date(2024, 1, 1), date(2024, 1, 30)),
)
LABEL_BEGIN, LABEL_END = date(2001, 2, 1), date(2001, 2, 28)
PROTO_FEATURE = (date(2000, 8, 1), date(2001, 1, 31))
PROTO_GROUPS = ("30", "101", "tg", "ntg")
BASELINE_CAP = date(2001, 2, 14)
TOP_N = 300
SUBMISSION_SIZE = 50_000  # lines of a flow's list
PAGERANK_UPDATES = 10
RANK_NODE = 15

# Survey number, name ({k} = window), aggregate, column (- = rows), group; a last + = windows of several months only.
REFACTORED_ORDERS = """
A1  {k}mo_order_30_101_num              nunique  o_id           30_101
A2  {k}mo_order_30_num                  nunique  o_id           30
A3  {k}mo_order_101_num                 nunique  o_id           101
A4  {k}mo_order_others_num              nunique  o_id           others
A5  {k}mo_order_all_num                 nunique  o_id           all
A6  {k}mo_order_30_101_item_count       count    sku_id         30_101
A7  {k}mo_order_30_item_count           count    sku_id         30
A8  {k}mo_order_101_item_count          count    sku_id         101
A9  {k}mo_order_others_item_count       count    sku_id         others
A10 {k}mo_order_all_item_num            nunique  sku_id         all
A11 {k}mo_order_30_101_date_num         nunique  o_date         30_101
A12 {k}mo_order_30_101_item_sum         sum      o_sku_num      30_101
A13 {k}mo_order_30_101_day_first        min      o_day          30_101
A14 {k}mo_order_30_day_first            min      o_day          30
A15 {k}mo_order_101_day_first           min      o_day          101
A16 {k}mo_order_30_101_day_last         max      o_day          30_101
A17 {k}mo_order_30_101_day_mean         mean     o_day          30_101
A18 {k}mo_order_30_101_month_num        nunique  o_month        30_101  +
A19 {k}mo_order_30_101_month_last       max      o_month        30_101  +
A20 {k}mo_order_30_101_date_gap_var     gap_std  o_date         30_101
A21 {k}mo_order_30_101_area_freq        mode     o_area         30_101
A22 {k}mo_order_30_101_consume_total    sum      o_total_price  30_101
A23 {k}mo_order_30_101_date_gap_mean    gap_mean o_date         30_101
A24 {k}mo_order_all_date_gap_mean       gap_mean o_date         all
A25 {k}mo_order_30_101_day_freq         mode     o_day          30_101
A27 {k}mo_order_30_101_score_count      rows     -              30_101_rated
A28 {k}mo_order_30_101_good_score_count rows     -              30_101_good
"""

BASELINE_ORDERS = """
A1  OM{k}_o_id_cate_30_101_cnt          nunique  o_id              30_101
A2  OM{k}_o_id_cate_30_cnt              nunique  o_id              30
A3  OM{k}_o_id_cate_101_cnt             nunique  o_id              101
A4  OM{k}_o_id_cate_other_cnt           nunique  o_id              others
A5  OM{k}_o_id_cate_all_cnt             nunique  o_id              all
A6  OM{k}_sku_id_cate_30_101_cnt        count    sku_id            30_101
A7  OM{k}_sku_id_cate_30_cnt            count    sku_id            30
A8  OM{k}_sku_id_cate_101_cnt           count    sku_id            101
A9  OM{k}_sku_id_cate_other_cnt         count    sku_id            others
A10 OM{k}_sku_id_nunique                nunique  sku_id            all
A11 OM{k}_o_date_cate_30_101_nuique     nunique  o_date            30_101
A12 OM{k}_o_sku_num_cate_30_101_sum     sum      o_sku_num         30_101
A13 OM{k}_day_cate_30_101_firstday      min      day               30_101
A14 OM{k}_day_cate_30_firstday          min      day               30
A15 OM{k}_day_cate_101_firstday         min      day               101
A16 OM{k}_day_cate_30_101_lastday       max      day               30_101
A17 OM{k}_day_cate_30_101_meanday       mean     day               30_101
A18 OM{k}_month_cate_30_101_monthnum    nunique  month             30_101  +
A19 OM{k}_month_cate_30_101_lastmonth   max      month             30_101  +
A20 OM{k}_o_date_cate_30_101_gap_var    gap_std  o_date            30_101
A21 OM{k}_area_most_common              mode     o_area            all
A22 OM{k}_total_consume                 sum      total_price       all
A23 OM{k}_o_date_cate_30_101_gap        gap_mean o_date            30_101
A24 OM{k}_o_date_cate_all_gap           gap_mean o_date            all
A25 OM{k}_day_most_common               mode     day               30_101
A26 OM{k}_num_comment_on_101_and_30     count    comment_create_tm 30_101
A28 OM{k}_good_score_on_30_101          rows     -                 30_101_good
"""

REFACTORED_ACTIONS = """
A29 {k}mo_action_30_101_sum           sum      a_num  30_101
A30 {k}mo_action_30_101_count         count    a_num  30_101
A30 {k}mo_action_30_101_date_count    count    a_date 30_101
A31 {k}mo_action_30_101_date_gap_mean gap_mean a_date 30_101
A33 {k}mo_action_30_101_day_freq      mode     a_day  30_101
"""

BASELINE_ACTIONS = """
A32 AM{k}_a_date_cate_30_101_gap    gap_mean a_date 30_101
A33 AM{k}_day_most_common           mode     day    30_101
A34 AM{k}_sku_id_cate_30_101_cnt    nunique  sku_id 30_101
A35 AM{k}_a_date_cate_30_101_nuique nunique  a_date 30_101
"""


def features(text: str, windows: tuple[Window, ...]) -> list[Feature]:
    """The table's rows for every window."""
    out = []
    for w in windows:
        for line in text.strip().splitlines():
            _, name, kind, col, where, *several = line.split()
            if not several or w.label != "1":
                out.append(Feature(name.format(k=w.label), kind, None if col == "-" else col, where, w.label))
    return out
