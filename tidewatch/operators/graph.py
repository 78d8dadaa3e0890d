"""Network features and rules on transfers as edges, each seen just before its row in (timestamp, transaction_id)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distributed import positions, prefix_sums, quantile_row, ratio
from ..functions.graphs import stored
from ..functions.metrics import average_precision, top_k
from ..functions.windows import exact, micros, role_history, running
from .rules import rule_hits

GRAPH_COLUMNS = ["graph_sender_out_degree", "graph_receiver_in_degree", "graph_sender_weighted_out_degree", "graph_receiver_weighted_in_degree", "graph_component_size", "graph_sender_pagerank", "graph_receiver_pagerank", "graph_cycle_involvement"]
_ORDER = ["timestamp", "transaction_id"]


#: Graph columns of what `role_history` tells.
_DEGREES = {"graph_sender_out_degree": "sender_partners", "graph_receiver_in_degree": "receiver_partners"}
_WEIGHTS = {"graph_sender_weighted_out_degree": "sender_amount", "graph_receiver_weighted_in_degree": "receiver_amount"}


def graph_degrees(tx: DataFrame) -> DataFrame:
    """Adds the sender's prior distinct receivers and the receiver's prior distinct senders."""
    return _with_history(tx, _DEGREES)


def graph_weighted_degrees(tx: DataFrame) -> DataFrame:
    """Adds the prior sums of what the sender has sent and the receiver received; a null amount is 0."""
    return _with_history(tx, _WEIGHTS)


def graph_history(tx: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Adds degrees and weighted degrees, from one sweep (`history`, where that of all transactions is at hand)."""
    return _with_history(tx, _DEGREES | _WEIGHTS, history)


def _with_history(tx: DataFrame, columns: dict[str, str], history: DataFrame | None = None) -> DataFrame:
    told = (role_history(tx) if history is None else history).select("transaction_id", *(F.col(c).cast("double" if n in _WEIGHTS else "long").alias(n) for n, c in columns.items()))
    return tx.join(told, "transaction_id")


def graph_centrality(tx: DataFrame) -> DataFrame:
    """Adds each side's share of all links: its distinct partners in both roles over twice the distinct pairs so far."""
    return tx.join(_shares(tx), "transaction_id")


def _shares(tx: DataFrame) -> DataFrame:
    """(transaction_id, graph_sender_pagerank, graph_receiver_pagerank).

    A running count over pairs tells by its zeros which rows bring a new pair. The count of pairs so far is a running total
    of those over all rows, taken in time ranges; degrees are running counts over an account's events in both roles. What
    is known of a row rides along, so no step is joined with another.
    """
    d = tx.select("transaction_id", "sender_account_id", "receiver_account_id", micros().alias("_us"))
    d = running(d, ["sender_account_id", "receiver_account_id"], "_us", ["transaction_id"], {"_met": F.lit(1).cast("long")})
    d = d.withColumns({"_new": (F.col("_met") == 0).cast("long"), "_at": F.struct("_us", "transaction_id")}).drop("_met", "_us", "transaction_id")
    d = prefix_sums(d, [], "_at", ["_new"])
    # an account on both sides of a row has one event for the two
    event = lambda c, *roles, times=1: F.struct(F.col(c).alias("account"), F.array(*map(F.lit, roles)).alias("roles"), (F.col("_new") * times).alias("n"))
    own = F.col("sender_account_id").eqNullSafe(F.col("receiver_account_id"))
    events = F.when(own, F.array(event("sender_account_id", 0, 1, times=2))).otherwise(F.array(event("sender_account_id", 0), event("receiver_account_id", 1)))
    d = d.select("_at.*", (F.col("_new_before") * 2).alias("_links"), F.explode(events).alias("_e")).select("_us", "transaction_id", "_links", "_e.*")
    accounts = tx.select(F.explode(F.array("sender_account_id", "receiver_account_id")).alias("account"))
    d = running(d, ["account"], "_us", ["transaction_id"], {"degree": F.col("n")}, counted=accounts)
    d = d.select("transaction_id", "_links", "degree", F.explode("roles").alias("role")).groupBy("transaction_id")
    of = lambda i: ratio(F.max(F.when(F.col("role") == i, F.col("degree"))), F.max("_links"))
    return d.agg(*(of(i).alias(f"graph_{name}_pagerank") for i, name in enumerate(("sender", "receiver"))))


def placed(tx: DataFrame) -> DataFrame:
    """(transaction_id, s, r, position) of all rows, stored: the edges of the network in order."""
    d = positions(tx.select("transaction_id", F.col("sender_account_id").alias("s"), F.col("receiver_account_id").alias("r"), micros().alias("_us")), "_us", ["transaction_id"])
    return stored(d.select("transaction_id", "s", "r", "position"), "graph-edges")


def cycle_flags(tx: DataFrame, max_length: int = 4) -> DataFrame:
    """(transaction_id, graph_cycle_involvement): 1 if sender and receiver are the same or prior edges lead from the
    receiver back to the sender in max_length - 1 steps at most."""
    if max_length < 2:
        return tx.select("transaction_id", F.lit(0).alias("graph_cycle_involvement"))
    return tx.select("transaction_id").join(_closing(placed(tx), max_length), "transaction_id", "left").select("transaction_id", F.coalesce("_hit", F.lit(0)).alias("graph_cycle_involvement"))


def _closing(d: DataFrame, max_length: int) -> DataFrame:
    """(transaction_id, _hit) of `placed` rows that close a cycle.

    First-seen edges suffice, since an earlier edge serves every later row, and of all ways between two accounts it is
    enough to know when the first was complete (`first_ways`).
    """
    rows = d.where("s <> r")
    e = stored(rows.groupBy(F.col("s").alias("a"), F.col("r").alias("b")).agg(F.min("position").alias("o")), "first-edges")
    ways = first_ways(e, e.select(F.col("b").alias("a"), F.col("a").alias("b")), max_length - 1)
    closed = rows.join(ways, (F.col("r") == F.col("a")) & (F.col("s") == F.col("b")) & (F.col("o") < F.col("position")), "left_semi").select("transaction_id")
    return closed.unionByName(d.where("s = r").select("transaction_id")).withColumn("_hit", F.lit(1))


def first_ways(edges: DataFrame, pairs: DataFrame, steps: int) -> DataFrame:
    """(a, b, o) of the pairs that edges (a, b, o) connect in so many steps at most: the least over all ways of the greatest
    o on the way.

    A step is listed from that end of a pair which has fewer edges, and what is left to find is a pair again, asked once
    however many ways lead through it. So a hub's edges are only listed towards a greater hub: in a star, however large,
    as many rows as there are edges, where steps joined at the hub would be its edges in times its edges out.
    """
    direct = pairs.join(edges, ["a", "b"])
    if steps == 1:
        return direct
    out, into = edges.groupBy("a").agg(F.count(F.lit(1)).alias("_out")), edges.groupBy("b").agg(F.count(F.lit(1)).alias("_in"))
    asked = pairs.join(out, "a").join(into, "b")
    step = edges.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("o").alias("o1"))
    ahead = asked.where("_out <= _in").join(step, F.col("a") == F.col("x")).select("a", "b", F.col("y").alias("ra"), F.col("b").alias("rb"), "o1")
    behind = asked.where("_out > _in").join(step, F.col("b") == F.col("y")).select("a", "b", F.col("a").alias("ra"), F.col("x").alias("rb"), "o1")
    listed = stored(ahead.unionByName(behind).where("ra <> rb"), "cycle-steps")
    rest = first_ways(edges, stored(listed.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "cycle-pairs"), steps - 1)
    rest = rest.select(F.col("a").alias("ra"), F.col("b").alias("rb"), "o")
    via = listed.join(rest, ["ra", "rb"]).select("a", "b", F.greatest("o1", "o").alias("o"))
    return stored(direct.unionByName(via).groupBy("a", "b").agg(F.min("o").alias("o")), "cycle-ways")


def component_sizes(tx: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(transaction_id, graph_component_size): accounts in the component that the row's edge forms with all prior edges.

    The network is made once, with an edge's first position as its weight, and asked for every row's time by its merge
    levels (`merge_levels`): what is connected to an account up to a position is, at the highest level that the account
    reaches by then, whatever else has reached that node by then. Counting those is a running sum per node, taken in
    ranges, so rounds and joins grow with the logarithm of the accounts and no task holds a component. `edges` is what
    `placed` gives, where it is at hand.
    """
    d = (placed(tx) if edges is None else edges).where("s is not null and r is not null")
    edges = d.where("s <> r").groupBy(F.least("s", "r").alias("a"), F.greatest("s", "r").alias("b")).agg(F.min("position").alias("o"))
    levels = stored(merge_levels(edges), "graph-levels")
    asked = d.join(levels, F.col("s") == F.col("account"), "left").withColumn("top", F.try_element_at(F.filter("levels", lambda x: x["o"] <= F.col("position")), F.lit(-1)))
    asked = stored(asked.select("transaction_id", "position", F.col("top.level").alias("level"), F.col("top.node").alias("node")), "graph-asked")
    came = levels.select(F.explode("levels").alias("x")).groupBy("x.level", "x.node", "x.o").agg(F.count(F.lit(1)).alias("n"))
    came = came.select("level", "node", (F.col("o") * 2).alias("at"), "n", F.lit(None).cast("long").alias("transaction_id"))
    asks = asked.where("node is not null").select("level", "node", (F.col("position") * 2 + 1).alias("at"), F.lit(0).cast("long").alias("n"), "transaction_id")
    sizes = prefix_sums(came.unionByName(asks), ["level", "node"], "at", ["n"]).where("transaction_id is not null").select("transaction_id", F.col("n_before").cast("long").alias("graph_component_size"))
    alone = asked.where("node is null").select("transaction_id", F.lit(1).cast("long").alias("graph_component_size"))
    return sizes.unionByName(alone)


def merge_levels(edges: DataFrame) -> DataFrame:
    """(account, levels) of undirected edges (a, b, o) with distinct weights o: the nodes that an account belongs to, from
    the lowest, each with the greatest weight on the account's way up to it.

    Rounds of Boruvka's spanning forest: every node takes its lightest edge out, and the nodes so joined are one node of
    the next level. Each round at least halves the nodes that still have edges. Two accounts are connected by edges up to
    a weight if and only if they have both reached a common node by then.
    """
    e = stored(edges.where("a <> b").select("a", "b", "o"), "forest-edges")
    accounts = e.select(F.col("a").alias("account")).unionByName(e.select(F.col("b").alias("account"))).distinct()
    at = accounts.select("account", F.col("account").alias("node"), F.lit(-1).cast("long").alias("o"), F.array().cast("array<struct<level:int,node:string,o:bigint>>").alias("levels"))
    level = 0
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "o"))
        best = stored(both.groupBy("a").agg(F.min(F.struct("o", "b")).alias("x")).select("a", "x.b", "x.o"), "forest-best")
        up = stored(_roots(best), "forest-up")
        step = up.select(F.col("a").alias("node"), F.col("root"), F.col("o").alias("step"))
        moved = at.join(step, "node", "left").withColumn("o", F.when(F.col("root").isNotNull(), F.greatest("o", "step")).otherwise(F.col("o")))
        reached = F.struct(F.lit(level).alias("level"), F.col("root").alias("node"), F.col("o").alias("o"))
        moved = moved.withColumn("levels", F.when(F.col("root").isNotNull(), F.array_append("levels", reached)).otherwise(F.col("levels")))
        at = stored(moved.select("account", F.coalesce("root", "node").alias("node"), "o", "levels"), "forest-levels")
        for side in ("a", "b"):
            e = e.join(up.select(F.col("a").alias(side), F.col("root").alias(f"r{side}")), side)
        e = e.where("ra <> rb").groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).agg(F.min("o").alias("o"))
        e, level = stored(e, "forest-edges"), level + 1
    return at.select("account", "levels")


def _roots(best: DataFrame) -> DataFrame:
    """(a, root, o): where each node's chain of lightest edges ends. The two ends of one edge that is the lightest of both
    end a chain, which the smaller name then stands for; ways are halved until all are at their end."""
    back = best.select(F.col("a").alias("b"), F.col("b").alias("of"))
    mine = (F.col("of") == F.col("a")) & (F.col("a") < F.col("b"))
    up = stored(best.join(back, "b", "left").select("a", F.when(mine, F.col("a")).otherwise(F.col("b")).alias("root"), "o"), "forest-roots")
    while True:
        far = up.select(F.col("a").alias("root"), F.col("root").alias("far"))
        up = stored(up.join(far, "root").select("a", F.col("far").alias("root"), "o", (F.col("far") != F.col("root")).alias("moved")), "forest-roots")
        if up.where("moved").isEmpty():
            return up.select("a", "root", "o")
        up = up.select("a", "root", "o")


def graph_features(tx: DataFrame, alerts: DataFrame, max_cycle_length: int = 4, max_alert_rows: int | None = None, max_transactions: int | None = None, suffix: str = "", history: DataFrame | None = None) -> DataFrame:
    """(transaction_id, sender_account_id, receiver_account_id, graph_*...) of alerted transactions, from all of them.

    Optional limits keep the earliest alerts or transactions only; `suffix` is put on the graph columns. `history` is that
    of all transactions, where it is at hand."""
    if max_transactions is not None:
        tx, history = tx.orderBy(*_ORDER).limit(max_transactions), None
    chosen = alerts.select("transaction_id", "alert_timestamp")
    if max_alert_rows is not None:
        chosen = chosen.orderBy("alert_timestamp", "transaction_id").limit(max_alert_rows)
    edges = placed(tx)
    d = tx.select("transaction_id", "sender_account_id", "receiver_account_id").join(chosen.select("transaction_id").distinct(), "transaction_id", "left_semi")
    d = _with_history(d, _DEGREES | _WEIGHTS, role_history(tx) if history is None else history).join(_shares(tx), "transaction_id")
    d = d.join(component_sizes(tx, edges), "transaction_id", "left")
    closing = _closing(edges, max_cycle_length) if max_cycle_length >= 2 else edges.limit(0).select("transaction_id", F.lit(1).alias("_hit"))
    d = d.join(closing.withColumnRenamed("_hit", "graph_cycle_involvement"), "transaction_id", "left")
    return d.select("transaction_id", "sender_account_id", "receiver_account_id", *(F.coalesce(c, F.lit(0)).alias(c + suffix) for c in GRAPH_COLUMNS))


def with_graph_features(features: DataFrame, graph: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Alert features with feature_<graph column> added or replaced; 0 where a transaction has none."""
    columns = list(columns or (c for c in graph.columns if c.startswith("graph_")))
    d = features.drop(*(f"feature_{c}" for c in columns)).join(graph.select("transaction_id", *columns), "transaction_id", "left")
    return d.select(*(c for c in d.columns if c not in columns), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"feature_{c}") for c in columns))


def graph_rules(tx: DataFrame, graph: DataFrame, min_degree: int = 3, min_component: int = 4, severity: str = "high") -> DataFrame:
    """GR1: well-connected accounts in a component of some size. GR2: transactions that close a cycle."""
    d = graph.join(tx.select("transaction_id", "timestamp", "is_laundering", "split"), "transaction_id", "left")
    evidence = {c: F.col(c) for c in ("sender_account_id", "receiver_account_id", "graph_sender_out_degree", "graph_receiver_in_degree", "graph_component_size", "graph_cycle_involvement")}
    hub = ((F.col("graph_sender_out_degree") >= min_degree) | (F.col("graph_receiver_in_degree") >= min_degree)) & (F.col("graph_component_size") >= min_component)
    one = rule_hits(d.where(hub), "GR1_GATHER_SCATTER", severity, evidence, {"min_degree": F.lit(min_degree), "min_component_size": F.lit(min_component)}, F.lit("Graph structure shows high account connectivity consistent with gather-scatter behavior."), "Graph gather-scatter concentration")
    two = rule_hits(d.where("graph_cycle_involvement = 1"), "GR2_CYCLE_CANDIDATE", severity, evidence, {"cycle_involvement": F.lit(1)}, F.lit("Transaction closes a short directed account cycle."), "Short-cycle candidate")
    return one.unionByName(two)


def cycle_summary(graph: DataFrame, graph_hits: DataFrame, cycle_rule: str = "GR2_CYCLE_CANDIDATE") -> DataFrame:
    mine = F.col("rule_id") == cycle_rule
    row = graph_hits.agg(F.count_if(mine).alias("cycle_candidate_count"), F.coalesce(F.sum(F.when(mine, F.col("is_laundering"))), F.lit(0)).alias("cycle_candidate_label_count"))
    d = graph.agg(F.count(F.lit(1)).alias("alert_transactions_evaluated")).join(row, how="cross")
    return d.unpivot([], d.columns, "metric", "value")


def gather_scatter_hubs(tx: DataFrame, min_sources: int = 3, min_destinations: int = 3, low: float = 0.5, high: float = 1.5) -> DataFrame:
    """Accounts that gather from several and pay to several about as much as they got, with the first and last times of both;
    no incoming money counts as a ratio of 0."""
    side = lambda me, other, n, x, w: tx.where(F.col(me).isNotNull()).groupBy(F.col(me).alias("hub_account_id")).agg(F.count_distinct(other).alias(n), F.sum(exact("amount")).cast("double").alias(x), F.min("timestamp").alias(f"first_{w}"), F.max("timestamp").alias(f"last_{w}"))
    d = side("receiver_account_id", "sender_account_id", "unique_sources", "incoming_amount", "in").join(side("sender_account_id", "receiver_account_id", "unique_destinations", "outgoing_amount", "out"), "hub_account_id")
    d = d.withColumn("amount_ratio", ratio(F.col("outgoing_amount"), F.col("incoming_amount")))
    d = d.where((F.col("unique_sources") >= min_sources) & (F.col("unique_destinations") >= min_destinations) & F.col("amount_ratio").between(low, high))
    return d.withColumn("evidence", F.struct("hub_account_id", "unique_sources", "unique_destinations", "incoming_amount", "outgoing_amount", "amount_ratio"))


def cycle_candidates(tx: DataFrame, min_length: int = 3, max_length: int = 5, max_hours: float = 72.0, min_similarity: float = 0.5, max_retention: float = 1.2, min_total: float = 0.0, risk_flag: str | None = None, max_transactions: int | None = None, any_in_window: bool = False) -> DataFrame:
    """Transactions that close a loop over prior transfers, with the loop found first: fewest steps, then earliest edges.

    The loop is then held against duration, the ratio of its least to its greatest amount, the closing amount against
    the rest, and its total against a quantile of all amounts. Ways are grown a step at a time; of those of one
    transaction to one account only the first is kept, since the shortest way is made of shortest ways, and of an edge
    between two accounts the earliest. Only transactions that close a loop at all are followed, and steps lead only to
    accounts from which a way back is left (`first_ways`, asked once for each pair of accounts), so rows grow with what
    lies on loops and not with the edges of hubs. `any_in_window` looks for ways among the transfers of the last
    max_hours only.
    """
    if max_transactions is not None:
        tx = tx.orderBy(*_ORDER).limit(max_transactions)
    cols = [risk_flag] if risk_flag else []
    d = positions(tx.withColumn("us", micros()), "us", ["transaction_id"]).select("transaction_id", "timestamp", "us", F.col("sender_account_id").alias("s"), F.col("receiver_account_id").alias("r"), F.coalesce("amount", F.lit(0.0)).alias("amount"), "is_laundering", "split", "position", *cols)
    d = stored(d, "cycle-edges")
    e = d.select(F.col("s").alias("es"), F.col("r").alias("er"), F.col("position").alias("ep"), F.col("us").alias("eu"), F.col("amount").alias("ea")).where("es is not null and er is not null")
    if not any_in_window:
        e = e.groupBy("es", "er").agg(F.min(F.struct("ep", "eu", "ea")).alias("f")).select("es", "er", "f.*")
    e = stored(e, "cycle-steps")
    hours = int(max_hours * 3600 * 1_000_000)
    prior = (F.col("ep") < F.col("position")) & ((F.col("eu") >= F.col("us") - hours) if any_in_window else F.lit(True))
    first = stored(e.groupBy(F.col("es").alias("a"), F.col("er").alias("b")).agg(F.min("ep").alias("o")), "cycle-first")
    closable = first_ways(first, d.where("s is not null and r is not null").select(F.col("r").alias("a"), F.col("s").alias("b")).distinct(), max(1, max_length - 1))
    leads = lambda rows, at, ways: rows.join(ways, (F.col(at) == F.col("a")) & (F.col("s") == F.col("b")) & (F.col("o") < F.col("position")), "left_semi")
    walk = d.where("s is not null and r is not null").select(
        "transaction_id", "s", "us", "position", F.col("r").alias("at"), F.array().cast("array<long>").alias("orders"),
        F.array().cast("array<double>").alias("amounts"), F.col("us").alias("first"), F.array("r").alias("nodes"),
    )
    walk = stored(leads(walk, "at", closable), "cycle-walk")
    seen, ends = walk.select("transaction_id", "at"), []
    taken = lambda x: (F.array_append("orders", F.col("ep")).alias("orders"), F.array_append("amounts", F.col("ea")).alias("amounts"), F.least("first", "eu").alias("first"), x)
    for hop in range(1, max_length):
        done = walk.join(e, (F.col("at") == F.col("es")) & (F.col("s") == F.col("er")) & prior).select("transaction_id", F.lit(hop).alias("hops"), *taken(F.col("nodes")))
        ends.append(stored(done.groupBy("transaction_id").agg(F.min_by(F.struct("hops", "orders", "amounts", "first", "nodes"), "orders").alias("p")), "cycle-found"))
        left = max_length - 1 - hop
        if not left:
            break
        going = stored(walk.join(ends[-1], "transaction_id", "left_anti"), "cycle-going")
        asked = going.select(F.col("at").alias("x"), F.col("s").alias("y")).distinct().join(first, F.col("x") == F.col("a"))
        asked = stored(asked.where("b <> y").select(F.col("b").alias("a"), F.col("y").alias("b")).distinct(), "cycle-asked")
        more = leads(going.join(e, (F.col("at") == F.col("es")) & prior).where("er <> s"), "er", first_ways(first, asked, left))
        more = more.select("transaction_id", "s", "us", "position", F.col("er").alias("at"), *taken(F.array_append("nodes", F.col("er")).alias("nodes")))
        more = more.join(seen, ["transaction_id", "at"], "left_anti")
        best = more.groupBy("transaction_id", "at").agg(F.min_by(F.struct("s", "us", "position", "orders", "amounts", "first", "nodes"), "orders").alias("w"))
        walk = stored(best.select("transaction_id", "at", "w.*"), "cycle-walk")
        seen = seen.unionByName(walk.select("transaction_id", "at"))
    found = reduce(DataFrame.unionByName, ends).select("transaction_id", "p.*")
    c = d.join(found, "transaction_id").withColumn("rest", F.aggregate("amounts", F.lit(0.0), lambda a, x: a + x))
    c = c.withColumns({
        "path_length": (F.col("hops") + 2).cast("long"), "cycle_path": F.concat_ws("->", F.array("s"), F.col("nodes"), F.array("s")),
        "total_cycle_amount": F.col("amount") + F.col("rest"), "cycle_retention_ratio": F.col("amount") / F.greatest(F.col("rest"), F.lit(1.0)),
        "duration_hours": (F.col("us") - F.col("first")) / 3.6e9,
        "amount_similarity_ratio": ratio(F.least("amount", F.array_min("amounts")), F.greatest("amount", F.array_max("amounts"))),
    }).join(F.broadcast(quantile_row(tx, "amount", {"least_total": min_total}, 0.0)), how="cross")
    ok = (F.col("path_length") >= min_length) & (F.col("duration_hours") <= max_hours) & (F.col("amount_similarity_ratio") >= min_similarity) & (F.col("cycle_retention_ratio") <= max_retention) & (F.col("total_cycle_amount") >= F.col("least_total"))
    if risk_flag:
        ok = ok & (F.coalesce(F.col(risk_flag).cast("int"), F.lit(0)) == 1)
    return c.where(ok).select("transaction_id", F.col("timestamp").alias("alert_timestamp"), "cycle_path", "path_length", "duration_hours", "amount_similarity_ratio", "cycle_retention_ratio", "total_cycle_amount", F.lit("research").alias("cycle_status"), F.lit(False).alias("eligible_for_p1_override"), "is_laundering", "split")


def graph_rules_v2(tx: DataFrame, hubs: DataFrame, cycles: DataFrame | None = None) -> DataFrame:
    """GR1_V2: every transaction with a hub on either side (escalation). GR2_V2: constrained cycles (research)."""
    hub = hubs.select("hub_account_id").distinct()
    touched = reduce(DataFrame.unionByName, (tx.join(hub, F.col(c) == F.col("hub_account_id"), "left_semi") for c in ("sender_account_id", "receiver_account_id"))).dropDuplicates(["transaction_id"])
    hits = rule_hits(touched, "GR1_GATHER_SCATTER_V2", "high", {c: F.col(c) for c in ("sender_account_id", "receiver_account_id")}, {"rule_version": F.lit("v2")}, F.lit("Account is linked to a constrained gather-scatter hub."), "Validated gather-scatter pattern")
    if cycles is not None:
        rows = cycles.withColumnRenamed("alert_timestamp", "timestamp")
        hits = hits.unionByName(rule_hits(rows, "GR2_CYCLE_CANDIDATE_V2", "high", {c: F.col(c) for c in ("cycle_path", "path_length")}, {"rule_version": F.lit("v2")}, F.lit("Transaction is part of a constrained short directed cycle."), "Constrained short-cycle candidate"))
    status = F.when(F.col("rule_id") == "GR1_GATHER_SCATTER_V2", "escalation").otherwise("research")
    return hits.withColumns({"graph_path_evidence": F.col("trigger_values_json"), "rule_status": status}).withColumns({"queue_eligible": F.col("rule_status") == "escalation", "volume_control_reason": F.when(F.col("rule_status") == "research", "research_only_not_direct_p1_p2").otherwise("")})


#: Variants of the ablation, the name of what each adds, and the words that pick its columns.
ABLATION = [
    ("A", "mvp_features_only", ()),
    ("B", "degree_features", ("degree",)),
    ("C", "degree_component_features", ("degree", "component")),
    ("D", "degree_component_pagerank_features", ("degree", "component", "pagerank")),
    ("E", "degree_component_pagerank_cycle_features", ("degree", "component", "pagerank", "cycle")),
]


def graph_ablation(features: DataFrame, score: str = "feature_rule_priority_score", variants: Sequence[tuple] = ABLATION, ks: Sequence[int] = (100, 500, 1000), cycle_labels: int = 0, split: str = "test") -> DataFrame:
    """Metrics on the test split of a base score plus 0.001 times each chosen column over its greatest size."""
    columns = [c for c in features.columns if c.startswith("feature_graph")]
    d = features
    if columns:
        d = d.join(F.broadcast(features.agg(*(F.max(F.abs(F.col(c).cast("double"))).alias(f"_m_{c}") for c in columns))), how="cross")
    base = F.coalesce(F.col(score).cast("double"), F.lit(0.0))
    part: dict[str, Column] = {c: F.lit(0.001) * ratio(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.col(f"_m_{c}")) for c in columns}
    d = d.withColumns({f"score_{v}": reduce(lambda a, b: a + b, (part[c] for c in columns if any(w in c for w in words)), base) for v, _, words in variants}).where(F.col("split") == split)
    # the areas of all variants are one pass
    d = stored(d.select("alert_id", "target", *(f"score_{v}" for v, _, _ in variants)), "ablation-scores")
    each = F.explode(F.array(*(F.struct(F.lit(v).alias("model_variant"), F.col(f"score_{v}").alias("s")) for v, _, _ in variants)))
    area = stored(average_precision(d.select("target", each.alias("x")).select("target", "x.*"), "target", "s", ["model_variant"]), "ablation-areas")
    rows = []
    for v, name, _ in variants:
        t = top_k(d, "target", f"score_{v}", ks, "alert_id")
        at = lambda c, k: F.max(F.when(F.col("k") == k, F.col(c)))
        one = t.agg(*(at("precision_at_k", k).alias(f"precision_at_{k}") for k in ks), at("recall_at_k", ks[-1]).alias(f"recall_at_{ks[-1]}"))
        own = area.where(F.col("model_variant") == v).agg(F.coalesce(F.max("pr_auc"), F.lit(0.0)).alias("pr_auc"))
        rows.append(own.join(one, how="cross").select(F.lit(v).alias("model_variant"), F.lit(name).alias("feature_group_added"), "*"))
    out = stored(reduce(DataFrame.unionByName, rows), "ablation-rows").withColumn("cycle_label_count", F.lit(cycle_labels).cast("long"))
    last = f"precision_at_{ks[-1]}"
    first = out.where(F.col("model_variant") == variants[0][0]).select(F.col(last).alias("_first"))
    out = out.join(F.broadcast(first), how="cross").withColumn(f"{last}_delta_vs_mvp", F.col(last) - F.col("_first")).drop("_first")
    research = F.col("feature_group_added").contains("cycle") & (F.col("cycle_label_count") == 0)
    return out.withColumn("decision", F.when(research, "research_only").when(F.col(f"{last}_delta_vs_mvp") >= 0, "keep").otherwise("remove"))
