"""Group conversion: for the oldest groups, message senders per added user.

* ``first_groups_by_registration``: the ``n`` earliest registered groups
  (ties broken by group id, unknown registration last).
* ``senders_per_group``: distinct users who wrote a message in each group.
* ``users_added_per_group``: distinct users with at least one ``add`` event
  in each of the first groups.
* ``group_conversion``: senders as a percentage of added users, rounded to
  two decimals; groups nobody was added to are absent, groups without
  messages have NULL senders and conversion.  Senders are not restricted to
  added users, so conversion can exceed 100.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST_GROUPS = 10
BROADCAST_ROWS = 500_000  # keys of 8 bytes: a few MB


def first_groups_by_registration(h_groups: DataFrame, n: int = FIRST_GROUPS) -> DataFrame:
    """Top-n by registration time (planned as a bounded top-k, no global sort)."""
    return h_groups.select("hk_group_id", "group_id", "registration_dt").orderBy(
        F.col("registration_dt").asc_nulls_last(), F.col("group_id").asc_nulls_last()
    ).limit(n)


def bounded(df: DataFrame, rows: int | None) -> DataFrame:
    """``df``, marked for broadcast if it is counted to hold at most ``rows`` rows (None: not counted)."""
    if rows is None or df.limit(rows + 1).count() > rows:
        return df
    return F.broadcast(df)


def senders_per_group(l_groups_dialogs: DataFrame, l_user_message: DataFrame,
                      groups: DataFrame | None = None, broadcast_rows: int | None = None) -> DataFrame:
    """Distinct senders per group; ``groups`` restricts the groups first.

    Whether ``groups`` is broadcast is the caller's call (it knows the bound).
    The messages of the groups, if they are few, filter the message links
    before those are shuffled.
    """
    gd = l_groups_dialogs.select("hk_group_id", "hk_message_id")
    um = l_user_message.select("hk_message_id", "hk_user_id")
    if groups is not None:
        gd = gd.join(groups.select("hk_group_id"), "hk_group_id", "left_semi")
        if broadcast_rows is not None:
            um = um.join(bounded(gd.select("hk_message_id"), broadcast_rows), "hk_message_id", "left_semi")
    return (
        gd.join(um, "hk_message_id", "left")
        .groupBy("hk_group_id")
        .agg(F.countDistinct("hk_user_id").alias("cnt_users_in_group_with_messages"))
    )


def users_added_per_group(l_user_group_activity: DataFrame, s_auth_history: DataFrame,
                          first_groups: DataFrame, broadcast_rows: int | None = None) -> DataFrame:
    """Distinct users added to each of the first groups.

    The links of those groups come first; if they are few, they filter the
    event history before it is shuffled.
    """
    links = (l_user_group_activity.select("hk_l_user_group_activity", "hk_group_id", "hk_user_id")
             .join(first_groups.select("hk_group_id"), "hk_group_id", "left_semi"))
    added = s_auth_history.where(F.col("event") == "add").select("hk_l_user_group_activity")
    if broadcast_rows is not None:
        added = added.join(bounded(links.select("hk_l_user_group_activity"), broadcast_rows),
                           "hk_l_user_group_activity", "left_semi")
    # one row per link with an add (a link with many adds collapses map-side,
    # so it cannot pile up on one side of the semi-join)
    return (
        links.join(added.distinct(), "hk_l_user_group_activity", "left_semi")
        .groupBy("hk_group_id")
        .agg(F.countDistinct("hk_user_id").alias("cnt_added_users"))
    )


def group_conversion(tables, n: int = FIRST_GROUPS, broadcast_rows: int | None = None) -> DataFrame:
    """The conversion report from vault tables (``tables(name) -> DataFrame``).

    ``broadcast_rows``: over stored tables, count the links and messages of the
    first groups and filter the histories by a broadcast of them up to so many
    rows; beyond it, and where it is None, the plan is left to Spark.
    """
    # at most n rows (a top-n): a proven bound, so it is broadcast
    first = F.broadcast(first_groups_by_registration(tables("h_groups"), n))
    added = users_added_per_group(tables("l_user_group_activity"), tables("s_auth_history"), first, broadcast_rows)
    # Only the first groups are reported, so only their messages are joined.
    senders = senders_per_group(tables("l_groups_dialogs"), tables("l_user_message"), first, broadcast_rows)
    ratio = F.col("cnt_users_in_group_with_messages") / F.col("cnt_added_users")
    return (
        added.join(senders, "hk_group_id", "left")
        .select(
            "hk_group_id",
            "cnt_added_users",
            "cnt_users_in_group_with_messages",
            F.round(ratio * 100, 2).alias("group_conversion"),
        )
        .orderBy(ratio.desc_nulls_last(), F.col("hk_group_id"))
    )
