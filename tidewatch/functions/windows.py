"""Trailing time windows over accounts: peers, rolling sums and distinct counts.

Rows are ordered by (timestamp, transaction_id). A window is open ((t - w, t]) or closed ([t - w, t]) on the left; rows
of equal time count only up to the row itself unless said otherwise. Null accounts belong to no window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .distributed import join_same
from .graphs import stored

MICROS = 1_000_000


def micros(c: str | Column = "timestamp") -> Column:
    return F.unix_micros(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp"))


def window_micros(window: str) -> int:
    """Microseconds of a length such as 24h, 90min, 30s or 7d."""
    number = window.rstrip("abcdefghijklmnopqrstuvwxyz")
    return int(float(number) * {"s": 1, "min": 60, "m": 60, "h": 3600, "d": 86400}[window[len(number) :]] * MICROS)


def exact(amount: str) -> Column:
    """Amounts as decimals, whose sums don't depend on the order of rows."""
    return F.coalesce(F.col(amount), F.lit(0.0)).cast("decimal(28,6)")


#: Length of the slices into which running sums cut the time of an account with many rows.
SLICE = 86_400 * MICROS
#: Cells of the table by which groups are counted, and the rows from which the groups of a cell are taken apart.
CELLS = 65_536
HEAVY = 100_000


def _cell(by: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(CELLS)).alias("_cell")


def heavy_cells(df: DataFrame, by: Sequence[str]) -> DataFrame | None:
    """(_cell) of groups that may have more than HEAVY rows, None without any.

    Groups are counted by a hash in a table of fixed size, so what comes to the driver is CELLS numbers at most however
    many groups there are. A small group in a full cell costs time only: taking groups apart changes no result.
    """
    full = [(r[0],) for r in df.groupBy(_cell(by)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HEAVY).collect()]
    return df.sparkSession.createDataFrame(full, "_cell long") if full else None


def running(df: DataFrame, by: Sequence[str], time: str, tie: Sequence[Column | str], sums: dict[str, Column], upto: bool = False, counted: DataFrame | None = None) -> DataFrame:
    """Adds running sums by (time, tie...) within each group: over all rows before each one or, with `upto`, it included.

    The time of groups with many rows is cut into slices, each of which begins with a row that carries the totals of the
    slices before it. A task sorts one slice of one group, so an account that has a great share of all rows does not hold
    up one task; other groups are sorted whole. Rows are dealt once and joined with nothing. `counted` has about as many
    rows of each group as `df`, where that is a cheaper table to count.
    """
    by = list(by)
    d = df.withColumns({f"_v_{n}": c for n, c in sums.items()})
    cells = heavy_cells(df if counted is None else counted, by)
    if cells is None:
        d = d.withColumns({"_k": F.lit(None).cast("long"), "_row": F.lit(1)})
    else:
        d, at = d.withColumn("_cell", _cell(by)), F.floor(F.col(time) / SLICE)
        earlier = W.partitionBy(*by).orderBy("_k").rowsBetween(W.unboundedPreceding, -1)
        carried = d.join(F.broadcast(cells), "_cell").groupBy(*by, at.alias("_k")).agg(*(F.sum(f"_v_{n}").alias(f"_v_{n}") for n in sums))
        carried = carried.select(*by, "_k", F.lit(0).alias("_row"), *(F.coalesce(F.sum(f"_v_{n}").over(earlier), F.lit(0)).alias(f"_v_{n}") for n in sums))
        d = d.join(F.broadcast(cells.withColumn("_many", F.lit(True))), "_cell", "left").withColumns({"_k": F.when(F.col("_many"), at), "_row": F.lit(1)})
        d = d.drop("_cell", "_many").unionByName(carried, allowMissingColumns=True)
    within = W.partitionBy(*by, "_k").orderBy("_row", time, *tie).rowsBetween(W.unboundedPreceding, 0 if upto else -1)
    d = d.withColumns({n: F.coalesce(F.sum(f"_v_{n}").over(within), F.lit(0)) for n in sums})
    return d.where("_row = 1").drop("_k", "_row", *(f"_v_{n}" for n in sums))


def _slices(df: DataFrame, time: str, w: int) -> DataFrame:
    """Rows in slices of time as long as the window, `_k`, each also in the next slice, for which it is `_context`."""
    own = F.floor(F.col(time) / w)
    return df.withColumn("_s", F.explode(F.array(F.struct(own.alias("k"), F.lit(False).alias("c")), F.struct((own + 1).alias("k"), F.lit(True).alias("c"))))).withColumns({"_k": F.col("_s.k"), "_context": F.col("_s.c")}).drop("_s")


def _swept(events: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Running sums over events (g, us, kind, id) of each account; those without a time are apart from all others."""
    return running(events.withColumn("_none", F.col("us").isNull()), ["g", "_none"], "us", ["kind", "id"], sums, upto=True).drop("_none")


def rolling(df: DataFrame, group: str, window: str, closed: bool, amount: str = "amount") -> DataFrame:
    """Adds rolling_count and rolling_sum of the group's window up to each row.

    A sweep: a row adds itself when it comes and takes itself off when its window is over, so running sums of these
    events are the sums of the window, and a row costs the same however many rows the window holds.
    """
    w = window_micros(window)
    d = df.where(F.col(group).isNotNull()).select(F.col(group).alias("g"), micros().alias("us"), F.col("transaction_id").alias("id"), exact(amount).alias("x"), F.struct(*df.columns).alias("row"))
    # at one time: what has run out goes first, then rows come in id order
    plus = d.select("g", "us", F.lit(1).alias("kind"), "id", F.lit(1).cast("long").alias("n"), "x", "row")
    minus = d.where("us is not null").select("g", (F.col("us") + (w + 1 if closed else w)).alias("us"), F.lit(0).alias("kind"), "id", F.lit(-1).cast("long").alias("n"), (-F.col("x")).alias("x"), F.when(F.lit(False), F.col("row")).alias("row"))
    out = _swept(plus.unionByName(minus), {"rolling_count": F.col("n"), "rolling_sum": F.col("x")}).where("kind = 1")
    return out.select("row.*", "rolling_count", F.col("rolling_sum").cast("double").alias("rolling_sum"))


def rolling_distinct(df: DataFrame, group: str, item: str, window: str, query_group: str | None = None) -> DataFrame:
    """(transaction_id, rolling_distinct): distinct items of the group in [t - w, t].

    With `query_group` a row asks about the account in that column instead, and sees all items of its own time.
    A sweep: an item adds one when it comes and takes one off just after its window, unless it comes again before that;
    running sums of these events are the counts, and no set is ever held.
    """
    w = window_micros(window)
    d = df.withColumn("_us", micros())
    came = d.where(F.col(group).isNotNull() & F.col(item).isNotNull()).select(F.col(group).alias("g"), F.col(item).alias("i"), F.col("_us").alias("us"), F.col("transaction_id").alias("id"))
    came = neighbours(came, ["g", "i"], ["us", "id"], "us", "was", "again")
    renewed = F.col("again").isNotNull() & (F.col("again") <= F.col("us") + w)
    came = came.withColumn("held", F.col("was").isNotNull() & (F.col("us") <= F.col("was") + w))
    came = stored(came.select("g", "us", "id", "held", renewed.alias("renewed")), "distinct")
    # at one time: what has run out goes first, then items come in id order, then questions of another role
    plus = came.select("g", "us", F.lit(1).alias("kind"), "id", F.when(F.col("held"), 0).otherwise(1).alias("step"))
    minus = came.where("not renewed").select("g", (F.col("us") + w + 1).alias("us"), F.lit(0).alias("kind"), "id", F.lit(-1).alias("step"))
    events = plus.unionByName(minus)
    if query_group:
        ask = d.where(F.col(query_group).isNotNull()).select(F.col(query_group).alias("g"), F.col("_us").alias("us"), F.lit(2).alias("kind"), F.col("transaction_id").alias("id"), F.lit(0).alias("step"))
        events = events.unionByName(ask)
    out = running(events, ["g"], "us", ["kind", "id"], {"n": F.col("step")}, upto=True).where(F.col("kind") == (2 if query_group else 1))
    return out.select(F.col("id").alias("transaction_id"), F.col("n").cast("long").alias("rolling_distinct"))


def incoming_to_sender(df: DataFrame, window: str, amount: str = "amount") -> DataFrame:
    """(transaction_id, incoming): what the row's sender has received in (t - w, t], rows of equal time included.

    A sweep as in `rolling`; what came at one time is summed first, and rows that ask come after it.
    """
    w = window_micros(window)
    d = df.withColumn("_us", micros())
    came = d.where("receiver_account_id is not null").groupBy(F.col("receiver_account_id").alias("g"), F.col("_us").alias("us")).agg(F.sum(exact(amount)).alias("x"))
    event = lambda d, us, kind, x: d.select("g", us.alias("us"), F.lit(kind).alias("kind"), "id", x.cast("decimal(38,6)").alias("x"))
    came, us = came.withColumn("id", F.lit(None).cast("long")), F.col("us")
    ask = d.where("sender_account_id is not null").select(F.col("sender_account_id").alias("g"), F.col("_us").alias("us"), F.col("transaction_id").alias("id"))
    events = event(came, us, 1, F.col("x")).unionByName(event(came.where("us is not null"), us + w, 0, -F.col("x"))).unionByName(event(ask, us, 2, F.lit(0)))
    return _swept(events, {"incoming": F.col("x")}).where("kind = 2").select(F.col("id").alias("transaction_id"), F.col("incoming").cast("double").alias("incoming"))


#: What `activity` tells of a row: of its sender, of its receiver, and of what its sender has received.
ACTIVITY = ("sent_count", "sent_sum", "receivers", "received_sum", "senders", "incoming", "funders")


def activity(df: DataFrame, window: str, amount: str = "amount") -> DataFrame:
    """Adds what `rolling`, `rolling_distinct` and `incoming_to_sender` tell of both sides of each row, all from one sweep:
    sent_count and sent_sum of the sender (open window), its receivers (closed), received_sum and senders of the receiver
    (closed), and the incoming amount (open) and funders (closed) of the sender. Ids tell rows apart.

    Partners come and run out as in `rolling_distinct`, told by one look at the neighbours within pairs; every row adds
    itself to its sender and its receiver, takes itself off both when their windows are over, and asks once.
    """
    w = window_micros(window)
    d = df.select(F.col("transaction_id").alias("id"), F.col("sender_account_id").alias("s"), F.col("receiver_account_id").alias("r"), micros().alias("us"), exact(amount).alias("a"))
    d = neighbours(d, ["s", "r"], ["us", "id"], "us", "was", "again")
    both = F.col("s").isNotNull() & F.col("r").isNotNull()
    came = F.when(both, F.when(F.col("was").isNotNull() & (F.col("us") <= F.col("was") + w), 0).otherwise(1))
    left = F.when(both & ~(F.col("again").isNotNull() & (F.col("again") <= F.col("us") + w)), -1)
    d = d.withColumns({"came": came, "left": left}).drop("was", "again")
    us, one, none, timeless = F.col("us"), F.lit(1), F.lit(None), F.col("us").isNull()
    # at one time: what has run out goes first, then rows come in id order, then questions; rows without a time go last
    over = F.when(timeless, 3).otherwise(0)

    def event(role: str, account: str, at: Column, kind: Column, n: Column = none, step: Column = none, x: Column = none, y: Column = none) -> Column:
        typed = ((n, "int", "n"), (step, "int", "step"), (x, "decimal(28,6)", "x"), (y, "decimal(28,6)", "y"))
        return F.struct(F.lit(role).alias("role"), F.col(account).alias("account"), at.alias("us"), kind.alias("kind"), *(c.cast(t).alias(name) for c, t, name in typed))

    a, sent, got = F.col("a"), "sent", "received"
    events = F.array(
        event(sent, "s", us, one, one, F.col("came"), a), event(sent, "s", us + w, over, F.lit(-1), none, -a), F.when(F.col("left").isNotNull(), event(sent, "s", us + w + 1, F.lit(0), none, F.col("left"))),
        event(got, "r", us, one, none, F.col("came"), a, a), event(got, "r", us + w, over, none, none, -a, F.when(timeless, -a)), event(got, "r", us + w + 1, F.lit(0), none, F.col("left"), none, F.when(~timeless, -a)), event(got, "s", us, F.lit(2)),
    )
    events = d.select("id", F.explode(events).alias("e")).where("e.account is not null").select("id", "e.*")
    of = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(f"{c}_account_id").alias("account"))
    counted = df.select(F.explode(F.array(of(sent, "sender"), of(got, "receiver"), of(got, "sender"))).alias("e")).select("e.*")
    told = running(events, ["role", "account"], "us", ["kind", "id"], {c: F.col(c) for c in ("n", "step", "x", "y")}, upto=True, counted=counted)
    told = told.where((F.col("kind") == 1) | (F.col("kind") == 2))
    told = told.select(F.col("id").alias("transaction_id"), F.when(F.col("kind") == 2, "asked").otherwise(F.col("role")).alias("as"), "n", "step", *(F.col(c).cast("double").alias(c) for c in ("x", "y")))
    at = lambda name, c: F.max(F.when(F.col("as") == name, F.col(c)))
    told = told.groupBy("transaction_id").agg(
        at(sent, "n").alias("sent_count"), at(sent, "x").alias("sent_sum"), at(sent, "step").alias("receivers"), at(got, "y").alias("received_sum"),
        at(got, "step").alias("senders"), at("asked", "x").alias("incoming"), at("asked", "step").alias("funders"),
    )
    known = F.col("sender_account_id").isNotNull() & F.col("receiver_account_id").isNotNull()
    return df.join(told, "transaction_id", "left").withColumns({c: F.when(known, F.col(c)) for c in ("receivers", "senders")})


#: What `role_history` tells of each role: rows, rows with a partner not met before, and amounts.
_MEASURES = ("count", "partners", "amount")


def role_history(df: DataFrame) -> DataFrame:
    """(transaction_id, pair_count, sender_count, sender_partners, sender_amount, receiver_count, ...): rows of the pair, and
    of each side in its role the rows, distinct partners and exact amounts, in all rows before this one.

    One sweep: a running count over pairs tells by its zeros who has met for the first time, and one running sum over
    events of both roles has all the rest. A null account is an account like others here, as a partner too.
    """
    d = df.select("transaction_id", "sender_account_id", "receiver_account_id", micros().alias("_us"), exact("amount").alias("amount"))
    d = stored(running(d, ["sender_account_id", "receiver_account_id"], "_us", ["transaction_id"], {"pair_count": F.lit(1).cast("long")}), "pair-history")
    role = lambda name, c: F.struct(F.lit(name).alias("role"), F.col(c).alias("account"))
    events = d.withColumn("_e", F.explode(F.array(role("sender", "sender_account_id"), role("receiver", "receiver_account_id"))))
    events = events.select("transaction_id", "_us", "pair_count", F.col("amount").alias("_amount"), "_e.*").withColumn("_new", (F.col("pair_count") == 0).cast("long"))
    sums = {"count": F.lit(1).cast("long"), "partners": F.col("_new"), "amount": F.col("_amount")}
    told = running(events, ["role", "account"], "_us", ["transaction_id"], sums)
    of = lambda role, m: F.max(F.when(F.col("role") == role, F.col(m))).alias(f"{role}_{m}")
    return told.groupBy("transaction_id").agg(F.max("pair_count").alias("pair_count"), *(of(r, m) for r in ("sender", "receiver") for m in _MEASURES))


def neighbours(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, before: str | None = None, after: str | None = None) -> DataFrame:
    """Adds the value of the row before, and of that after, within each group by `order`; null at the ends.

    Groups with many rows are dealt to ranges of (by, order), written once; a range's first and last values are handed to
    the ranges next to it, so a group of any size is sorted in many tasks. Other groups are sorted whole. `order` should
    tell rows apart.
    """
    by = list(by)
    cells = heavy_cells(df, by)
    if cells is None:
        return _beside(df, by, order, value, before, after)
    d = df.withColumn("_cell", _cell(by))
    light = _beside(d.join(F.broadcast(cells), "_cell", "left_anti").drop("_cell"), by, order, value, before, after)
    d = d.join(F.broadcast(cells), "_cell", "left_semi").drop("_cell")
    d = stored(d.repartitionByRange(*by, *order).withColumn("_r", F.spark_partition_id()), "neighbours")
    key, ranges = F.struct(*order), W.partitionBy(*by).orderBy("_r")
    edges = d.groupBy(*by, "_r").agg(F.min_by(value, key).alias("_first"), F.max_by(value, key).alias("_last"))
    edges = edges.select(*by, "_r", F.lag("_last").over(ranges).alias("_b"), F.lead("_first").over(ranges).alias("_a"))
    d = _beside(join_same(d, edges, [*by, "_r"]), [*by, "_r"], order, value, before, after)
    ends = {c: F.coalesce(c, end) for c, end in ((before, "_b"), (after, "_a")) if c}
    return light.unionByName(d.withColumns(ends).drop("_r", "_a", "_b"))


def _beside(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, before: str | None, after: str | None) -> DataFrame:
    """`neighbours` with every group sorted whole."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumns({c: f(value).over(w) for c, f in ((before, F.lag), (after, F.lead)) if c})
