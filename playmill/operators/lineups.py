"""Reconstructing lineups from season totals: quotas spread over games, without a solver."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from .windows import FIRST, LAST, over

TEAM = ["season", "team"]


def position_games(df: DataFrame, joint: str, parts: list[str]) -> DataFrame:
    """position and games of each row's positions: a joint total is split over its parts in proportion, or evenly if they are all 0."""
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    split = df.withColumns({p: F.when(total > 0, F.col(joint) * F.col(p) / total).otherwise(F.col(joint) / len(parts)) for p in parts}).drop(joint)
    keys = [c for c in split.columns if c not in parts]
    return split.unpivot(keys, parts, "position", "games").where("games > 0")


def candidates(fielding: DataFrame, batting: DataFrame, present: DataFrame) -> DataFrame:
    """Fielding totals of team-seasons that are present, with batting totals beside."""
    return fielding.join(present.select(*TEAM).distinct(), TEAM, "left_semi").join(batting, [*TEAM, "player"], "left")


def modal(df: DataFrame, size: int = 9) -> DataFrame:
    """The players with most games, each at its modal position, in batting order. df: team, season, player, position, games, pa; rows without games don't count."""
    c, df = F.col, df.where("games > 0")
    best = F.min_by("position", F.struct(-c("games"), c("position"))).alias("position")
    players = df.groupBy(*TEAM, "player").agg(F.sum("games").alias("games"), F.sum("pa").alias("pa"), best)
    top = players.withColumn("_n", F.row_number().over(over(TEAM, [F.desc("games"), F.desc("pa"), "player"]))).where(c("_n") <= size)
    return order_by_rate(top.drop("_n"))


def order_by_rate(df: DataFrame) -> DataFrame:
    """slot by plate appearances a game, ties by plate appearances and player; pitchers bat last."""
    rate = F.try_divide(F.col("pa").cast("double"), F.col("games"))
    pitches = (F.col("position") == 1).cast("int")
    return df.withColumn("slot", F.row_number().over(over(TEAM, [pitches, rate.desc(), F.desc("pa"), "player"])))


def modal_repair(chosen: DataFrame, pool: DataFrame, size: int = 9) -> DataFrame:
    """Fills positions that a modal lineup leaves open; one task a team and season, whose roster is all it holds.

    In order of position: the weakest of those who share a position makes way
    for the best outsider who plays the open one; else a member who plays it and
    whose own position is shared moves there; else the team has no lineup.
    """

    columns = ["season", "team", "player", "position", "games", "pa"]
    kinds = pa.schema([("season", pa.int32()), ("team", pa.int64()), ("player", pa.int64()), ("position", pa.int32()), ("games", pa.int64()), ("pa", pa.int64())])

    def repair(have: pa.Table, roster: pa.Table) -> pa.Table:
        members, options, totals = have.select(columns).to_pylist(), roster.to_pylist(), {}
        for o in options:
            games, pa_all = totals.get(o["player"], (0, 0))
            totals[o["player"]] = games + (o["games"] or 0), pa_all + (o["pa"] or 0)
        for wanted in range(1, size + 1) if members else ():
            at = [m["position"] for m in members]
            if wanted in at:
                continue
            shared = sorted((m for m in members if at.count(m["position"]) > 1), key=lambda m: (m["games"], m["pa"], m["player"]))
            able = [o for o in options if o["position"] == wanted]
            inside, by_player = {m["player"] for m in members}, {m["player"]: m for m in shared}
            new = min((o for o in able if o["player"] not in inside), key=lambda o: (-o["games"], *(-x for x in totals[o["player"]]), o["player"]), default=None)
            mover = min((o for o in able if o["player"] in by_player), key=lambda o: (-o["games"], o["player"]), default=None)
            if shared and new:
                shared[0].update(player=new["player"], position=wanted, games=totals[new["player"]][0], pa=totals[new["player"]][1])
            elif shared and mover:
                by_player[mover["player"]]["position"] = wanted
            else:
                members = []
                break
        return pa.Table.from_pylist(members, kinds)

    schema = "season int, team long, player long, position int, games long, pa long"
    pool = pool.toDF(*pool.columns)  # columns of their own, should chosen come of the same rows
    return order_by_rate(chosen.groupBy(*TEAM).cogroup(pool.groupBy(*TEAM)).applyInArrow(repair, schema))


def rescale(df: DataFrame, sides: str = "sides") -> DataFrame:
    """target: games at a position, a player's cut to what it batted in, then a position's to the games there were."""
    player = F.sum("games").over(over([*TEAM, "player"]))
    cut = df.withColumn("_a", F.col("games") * F.least(F.lit(1.0), F.try_divide(F.col("batted").cast("double"), player)))
    whole = F.sum("_a").over(over([*TEAM, "position"]))
    return cut.withColumn("target", F.col("_a") * F.least(F.lit(1.0), F.try_divide(F.col(sides).cast("double"), whole))).drop("_a")


def rescale_stints(df: DataFrame) -> DataFrame:
    """target and stint_total by season, team, player, stint and position, within three margins.

    A stint's games at all positions are cut to the games it batted in; a
    player's games with a team (what it batted in where a stint was cut) are
    shared among its stints by their games so far; a position's games are cut to
    the sides that the team played. df: games, batted (of the stint), total (of
    the player with the team) and sides. Rows without games go.
    """
    c, stint, player, position = F.col, [*TEAM, "player", "stint"], [*TEAM, "player"], [*TEAM, "position"]
    double = lambda name: c(name).cast("double")
    within = lambda value, keys: F.sum(value).over(over(keys))
    cut = df.withColumns({"_fielded": within(double("games"), stint), "_batted": F.max(double("batted")).over(over(stint)), "_whole": F.max(double("total")).over(over(stint))}).where("games > 0")
    down = c("_fielded") > c("_batted")
    cut = cut.withColumns({"_games": F.when(down, c("games") * c("_batted") / c("_fielded")).otherwise(double("games")), "_total": F.when(down, c("_batted")).otherwise(c("_whole"))})
    shared = cut.withColumns({"_stint": within("_games", stint), "_team": within("_games", player), "_most": F.max("_total").over(over(player))})
    shared = shared.withColumn("stint_total", F.when(c("_team") > 0, c("_most") * c("_stint") / c("_team")).otherwise(c("_total")))
    made = shared.withColumn("_made", within("_games", position))
    target = F.when((c("_made") > c("sides")) & (c("sides") > 0), c("_games") * c("sides") / c("_made")).otherwise(c("_games"))
    return made.withColumn("target", target).where("target > 0").drop(*[n for n in made.columns if n.startswith("_")])


def _numbered(dates: DataFrame) -> DataFrame:
    return dates.select("season", "day").distinct().withColumn("i", F.row_number().over(over(["season"], ["day"])))


def _shares(stints: DataFrame, numbered: DataFrame) -> DataFrame:
    """Adds _a and _b, the first and last of the season's n days, by the stints' cumulative shares of games."""
    n = numbered.groupBy("season").agg(F.max("i").alias("n"))
    to_date = F.sum("games").over(over(["season", "player"], ["stint"]))
    total = F.sum("games").over(over(["season", "player"]))
    cut = stints.withColumns({"_end": to_date / total, "_start": (to_date - F.col("games")) / total}).join(n, "season")
    return cut.withColumns({"_a": F.least(F.col("n"), F.floor(F.col("_start") * F.col("n")).cast("int") + 1), "_b": F.greatest(F.lit(1), F.floor(F.col("_end") * F.col("n")).cast("int"))})


def _dated(cut: DataFrame, numbered: DataFrame, keys: list[str]) -> DataFrame:
    days = lambda i, name: numbered.select("season", F.col("i").alias(i), F.col("day").alias(name))
    return cut.join(days("_a", "from_date"), ["season", "_a"]).join(days("_b", "to_date"), ["season", "_b"]).select(*keys, "from_date", F.greatest("from_date", "to_date").alias("to_date"))


def stint_windows(stints: DataFrame, dates: DataFrame) -> DataFrame:
    """from_date and to_date of each stint: a season's dates cut at the stints' cumulative shares of games. stints: season, player, stint, games; dates: season, day."""
    numbered = _numbered(dates)
    return _dated(_shares(stints, numbered), numbered, ["season", "player", "stint"])


def transfer_days(stints: DataFrame, transfers: DataFrame) -> DataFrame:
    """The days on which a player went from each team of a season to the next: season, player, days.

    Moves are taken in order of day and seq; each has to lead from the team of
    one stint to that of the next. Players who were twice with a team, or for
    whom a move is missing, don't come out. A player's stints and moves within
    a season meet in one row, so their number has to be small.
    """
    who = ["season", "player"]
    teams = stints.groupBy(*who).agg(F.sort_array(F.collect_list(F.struct("stint", "team"))).alias("teams")).where("size(teams) > 1 AND size(array_distinct(transform(teams, t -> t.team))) = size(teams)")
    moves = transfers.groupBy(*who).agg(F.sort_array(F.collect_list(F.struct("day", "seq", "old", "new"))).alias("moves"))
    team = lambda k: F.get("teams", k)["team"]

    def follow(days: Column, move: Column) -> Column:
        here = F.size(days)
        return F.when((move["old"] == team(here)) & (move["new"] == team(here + 1)), F.concat(days, F.array(move["day"]))).otherwise(days)

    found = teams.join(moves, who).withColumn("days", F.aggregate("moves", F.array().cast("array<date>"), follow))
    return found.where("size(days) = size(teams) - 1").select(*who, "days")


def transferred_windows(stints: DataFrame, sides: DataFrame, transfers: DataFrame) -> DataFrame:
    """Windows of stints bounded by transfers where these explain a player's teams, else by shares of games.

    The day of a transfer is in both windows. A window by shares that holds
    fewer days of its team than the stint has games grows round its middle to
    the nearest days, earlier ones first. A single stint has the whole season.
    stints: season, player, stint, team, games; sides: season, team, day;
    transfers: season, player, day, seq, old, new.
    """
    c, key = F.col, ["season", "player", "stint"]
    numbered = _numbered(sides)
    cut = _shares(stints, numbered).withColumns({"_k": F.row_number().over(over(["season", "player"], ["stint"])), "_stints": F.count("*").over(over(["season", "player"]))})
    season = numbered.groupBy("season").agg(F.sort_array(F.collect_list("day")).alias("_days"))
    told = cut.join(transfer_days(stints, transfers), ["season", "player"]).join(season, "season")
    before, after = F.get("days", c("_k") - 2), F.get("days", c("_k") - 1)
    first = F.when(before.isNull(), 1).otherwise(F.least(c("n"), F.size(F.filter("_days", lambda d: d < before)) + 1))
    last = F.when(after.isNull(), c("n")).otherwise(F.size(F.filter("_days", lambda d: d <= after)))
    bounded = told.select(*key, first.alias("_a"), F.greatest(first, last).alias("_b"))

    shared = cut.join(bounded.select(*key), key, "left_anti")
    days = numbered.join(sides.select("season", "team", "day").distinct(), ["season", "day"]).select("season", "team", "i")
    own = shared.where("_stints > 1").join(days, ["season", "team"])
    near = F.row_number().over(over(key, [F.abs(c("i") - F.floor((c("_a") + c("_b")) / 2)), "i"]))
    inside = F.count_if(c("i").between(c("_a"), c("_b"))).over(over(key))
    wanted = own.withColumns({"_near": near, "_inside": inside}).where("_inside < games AND _near <= games")
    grown = wanted.groupBy(*key).agg(F.min("i").alias("_first"), F.max("i").alias("_last"))
    widened = shared.join(grown, key, "left").select(*key, F.least("_a", "_first").alias("_a"), F.greatest("_b", "_last").alias("_b"))
    return _dated(stints.select(*key, "team").join(bounded.unionByName(widened), key), numbered, [*key, "team"])


def eligibility(pool: DataFrame, sides: DataFrame) -> DataFrame:
    """Each game side with those whose window holds the date and who don't pitch that day."""
    joined = sides.join(pool, TEAM)
    return joined.where(F.col("day").between(F.col("from_date"), F.col("to_date")) & ~F.col("player").eqNullSafe(F.col("pitcher")))


def quotas(targets: DataFrame) -> DataFrame:
    """Adds quota: targets as whole numbers that add up, for each position, to what the targets do (the largest remainders go up)."""
    at = [*TEAM, "position"]
    cut = targets.withColumn("_floor", F.floor("target").cast("int"))
    rank = F.row_number().over(over(at, [F.desc(F.col("target") - F.col("_floor")), "player"]))
    left = F.round(F.sum("target").over(over(at))).cast("int") - F.sum("_floor").over(over(at))
    return cut.withColumn("quota", F.col("_floor") + F.when(rank <= left, 1).otherwise(0)).drop("_floor")


def _rounds(offers: DataFrame) -> DataFrame:
    """Deferred acceptance of offers (game, TEAM, player, position, target, quota): those that are held in the end.

    In each round a (player, position) below its quota proposes to its next
    games. All at a position have the games in one order, by a hash, and each
    begins where the quotas before it end, so few meet. A side holds, for a position and then for a
    player, the offer with the largest target still to come, and refuses the
    others for good; a refused offer opens its quota again. Teams in which
    nothing moved are settled and leave the rounds. There are as many rounds as
    refusals in a row at most: an offer is made once.
    """
    c, side, quota = F.col, ["game", *TEAM], [*TEAM, "player", "position"]
    at = [*TEAM, "position"]
    before = offers.select(*quota, "target", "quota").distinct().withColumn("_before", F.sum("quota").over(over(at, [F.desc("target"), "player"])) - c("quota"))
    place = F.dense_rank().over(over(at, [F.xxhash64("game", "position"), "game"]))
    placed = offers.withColumn("_o", place).join(before.select(*quota, "_before"), quota)
    placed = placed.withColumn("_o", F.pmod(c("_o") - 1 - c("_before"), F.max("_o").over(over(at)))).drop("_before")
    state = placed.withColumn("_s", F.lit(0))  # 0 untried, 1 held, 2 refused
    settled = []
    while True:
        line = over(quota, [(c("_s") != 0).cast("int"), "_o", "game"])
        held = F.sum((c("_s") == 1).cast("int")).over(over(quota, [(c("_s") != 0).cast("int"), "_o", "game"], (FIRST, LAST)))
        asked = state.withColumns({"_held": held, "_n": F.row_number().over(line)})
        asked = asked.withColumns({"_asks": (c("_s") == 0) & (c("_n") <= c("quota") - c("_held")), "_left": c("target") - c("_held")})
        asked = asked.withColumn("_on", (c("_s") == 1) | c("_asks")).repartition(*side)
        best = lambda keys, on, tie: F.row_number().over(over(keys, [F.desc(on), F.desc("_left"), tie]))
        kept = asked.withColumn("_on2", c("_on") & (best([*side, "position"], "_on", "player") == 1))
        kept = kept.withColumn("_on3", c("_on2") & (best([*side, "player"], "_on2", "position") == 1))
        now = F.when(c("_on3"), 1).when(c("_on"), 2).otherwise(c("_s"))
        made = written(kept.withColumn("_s", now).select(*offers.columns, "_o", "_s", "_asks"), "offers")
        moved = made.where("_asks").select(*TEAM).distinct()
        settled.append(made.join(moved, TEAM, "left_anti").where("_s = 1").select(*offers.columns))
        if moved.isEmpty():
            return reduce(DataFrame.unionAll, settled)
        state = made.join(moved, TEAM, "left_semi").drop("_asks")


def _must_appear(held: DataFrame, offers: DataFrame, outs: DataFrame, more_than: int) -> DataFrame:
    """Gives who played more than so many outs, has a target of a game and appears nowhere the place of a holder who keeps another appearance.

    A player takes the game and position, among those offered, whose holder
    appears most; a holder gives way once, and a player takes one.
    """
    c, who = F.col, [*TEAM, "player"]
    wanted = offers.groupBy(*who, "position").agg(F.first("target").alias("target")).groupBy(*who).agg(F.sum("target").alias("_all")).where("_all >= 1")
    missing = wanted.join(outs.where(c("outs") > more_than).select(*who).distinct(), who, "left_semi").join(held.select(*who), who, "left_anti")
    often = held.withColumn("_times", F.count("*").over(over(who))).where("_times > 1").select("game", *TEAM, "position", c("player").alias("_holder"), "_times")
    options = offers.join(missing, who).join(often, ["game", *TEAM, "position"])
    first = lambda keys: F.row_number().over(over(keys, [F.desc("_times"), F.desc("target"), "game", "position", "player"]))
    # One place for each holder, then one for each player.
    once = options.withColumn("_n", first([*TEAM, "_holder"])).where("_n = 1").withColumn("_n", first(who)).where("_n = 1")
    taken = once.select("game", *TEAM, "position", "player", "target", "quota")
    return held.join(taken.select("game", *TEAM, "position"), ["game", *TEAM, "position"], "left_anti").unionByName(taken.select(*held.columns))


def assign(eligible: DataFrame, lineup: DataFrame, outs: DataFrame | None = None, more_than: int = 23) -> DataFrame:
    """game, season, team, position, slot and player: games of a season dealt to players by their targets, around a whole lineup.

    eligible: game, season, team, player, position, target. lineup: season, team,
    position, slot, player, with each position, slot and player once. outs, if
    given, has season, team, player and outs: who has more than so many, and a
    target of a game or more, appears at least once if anyone can make way.
    Places are filled by deferred acceptance; what stays open falls to the
    lineup's own player, or else to members without a place, in order. Members
    keep their slots, others take the slots of members who aren't in the game:
    of the one they stand in for, if it is free. So every side has each
    position, slot and player once.
    """
    c, side = F.col, ["game", *TEAM]
    given = quotas(eligible.select(*TEAM, "player", "position", "target").distinct())
    offers = written(eligible.select(*side, "player", "position").join(given, [*TEAM, "player", "position"]).select(*side, "player", "position", "target", "quota"), "offered")
    # A quota of 0 may still be needed by one who must appear.
    held = written(_rounds(offers.where("quota > 0")), "held")
    if outs is not None:
        held = written(_must_appear(held, offers, outs, more_than), "held")
    held = held.select(*side, "position", "player")
    members = eligible.select(*side).distinct().join(lineup.select(*TEAM, "position", "slot", "player"), TEAM)
    free = members.join(held.select(*side, "player"), [*side, "player"], "left_anti")
    open_ = members.select(*side, "position").join(held.select(*side, "position"), [*side, "position"], "left_anti")
    own = free.join(open_, [*side, "position"]).select(*side, "position", "player")
    n = lambda df, order: df.withColumn("_n", F.row_number().over(over(side, order)))
    rest = n(open_.join(own, [*side, "position"], "left_anti"), ["position"]).join(n(free.join(own.select(*side, "player"), [*side, "player"], "left_anti").drop("position"), ["slot"]), [*side, "_n"]).select(*side, "position", "player")
    filled = written(held.unionByName(own).unionByName(rest), "filled")

    in_game = filled.join(lineup.select(*TEAM, "player", "slot"), [*TEAM, "player"], "left")
    outsiders = in_game.where("slot IS NULL").drop("slot")
    unused = members.join(filled.select(*side, "player"), [*side, "player"], "left_anti").select(*side, "position", "slot")
    same = outsiders.join(unused, [*side, "position"]).select(*side, "position", "player", "slot")
    others = n(outsiders.join(same.select(*side, "player"), [*side, "player"], "left_anti"), ["position"]).join(n(unused.join(same.select(*side, "slot"), [*side, "slot"], "left_anti").drop("position"), ["slot"]), [*side, "_n"])
    columns = [*side, "position", "slot", "player"]
    return in_game.where("slot IS NOT NULL").select(*columns).unionByName(same.select(*columns)).unionByName(others.select(*columns))


def pitcher_slot(assigned: DataFrame, sides: DataFrame, pool: DataFrame, pitching: int = 1) -> DataFrame:
    """The day's pitcher in the place and slot of whoever was to pitch.

    A pitcher who was down elsewhere leaves a position and slot to the best of
    the pool (season, team, player, position, games) who isn't in the game: by
    games at the position, games in all, then id; failing any, to the displaced
    pitcher.
    """
    side = ["game", *TEAM]
    joined = assigned.join(sides.where("pitcher IS NOT NULL").select(*side, "pitcher"), side, "left")
    pitches, elsewhere = F.col("position") == pitching, F.col("player").eqNullSafe(F.col("pitcher")) & (F.col("position") != pitching)
    kept = joined.where(~elsewhere).withColumn("player", F.when(pitches, F.coalesce("pitcher", "player")).otherwise(F.col("player"))).select(*side, "position", "slot", "player")
    displaced = joined.where(pitches).select(*side, F.col("player").alias("displaced"))
    holes = joined.where(elsewhere).select(*side, "position", "slot")
    whole = pool.groupBy(*TEAM, "player").agg(F.sum("games").alias("total"))
    able = holes.join(pool.where("games > 0").select(*TEAM, "player", "position", "games"), [*TEAM, "position"]).join(whole, [*TEAM, "player"])
    last = holes.join(displaced, side).select(*side, "position", "slot", F.col("displaced").alias("player"), F.lit(-1).cast("long").alias("games"), F.lit(-1).cast("long").alias("total"))
    every = able.select(*last.columns).unionByName(last).join(kept.select(*side, "player"), [*side, "player"], "left_anti")
    # Several holes of a side can't be: a player is in a lineup once.
    best = every.withColumn("_n", F.row_number().over(over([*side, "position"], [F.desc("games"), F.desc("total"), "player"]))).where("_n = 1")
    return kept.unionByName(best.select(*kept.columns))


def report(targets: DataFrame, assigned: DataFrame) -> DataFrame:
    """Actual and realised games of each player and position, with errors ranked."""
    keys = [*TEAM, "player", "position"]
    a = targets.groupBy(*keys).agg(F.sum("target").alias("actual"))
    b = assigned.groupBy(*keys).agg(F.count("*").alias("realised"))
    both = a.join(b, keys, "full").fillna(0, ["actual", "realised"])
    error = F.col("realised") - F.col("actual")
    out = both.withColumns({"error": error, "abs_error": F.abs(error), "pct_error": F.abs(error) / F.greatest("actual", F.lit(1.0))})
    return out.withColumn("error_rank", F.row_number().over(over(["season"], [F.desc("pct_error"), F.desc("abs_error"), *keys])))


def backtest(guess: DataFrame, truth: DataFrame, by: list[str]) -> DataFrame:
    """For each ``by``: wrong starters and positions, and set_miss_rate = 1 - sum of the smaller counts / all real ones."""
    keys = ["game", *TEAM]
    g = guess.select(*keys, "player", F.col("position").alias("guessed"))
    t = truth.select(*keys, "player", F.col("position").alias("real"))
    both = g.join(t, [*keys, "player"], "full")
    hit = F.col("guessed").isNotNull() & F.col("real").isNotNull()
    return both.groupBy(*by).agg(
        F.count_if(F.col("real").isNotNull() & F.col("guessed").isNull()).alias("wrong_starters"),
        F.count_if(hit & (F.col("guessed") != F.col("real"))).alias("wrong_positions"),
        (1 - F.try_divide(F.count_if(hit), F.count_if(F.col("real").isNotNull()))).alias("set_miss_rate"),
    )


def backtest_levels(guess: DataFrame, truth: DataFrame, eras: tuple[int, int, int], sizes: list[int], groups: dict[int, str], pitching: int = 1) -> DataFrame:
    """set_miss_rate, 1 - sum of the smaller starts / all real starts, with starts told by player, by player and position group, and by player and position, in one pass of grouping sets.

    Rates are by level, era (n spans of equal width from the first season, counted
    from 1) and the place of the team's games among the bounds in sizes. Rows of
    pitchers in either lineup are left out. groups names each position's group.
    """
    c, keys = F.col, ["game", *TEAM, "player"]
    both = guess.select(*keys, c("position").alias("_guessed")).join(truth.select(*keys, c("position").alias("_real")), keys, "full")
    both = both.where(f"coalesce(_guessed, 0) <> {pitching} AND coalesce(_real, 0) <> {pitching}")
    starts = F.explode(F.array(*[F.struct(c(name).alias("position"), *[F.lit(int(name == n)).alias(s) for n, s in (("_guessed", "guessed"), ("_real", "real"))]) for name in ("_guessed", "_real")]))
    named = F.create_map(*[F.lit(x) for pair in groups.items() for x in pair])
    rows = both.select(*TEAM, "player", starts.alias("_x")).select(*TEAM, "player", "_x.*").where("position IS NOT NULL").withColumn("position_group", named[c("position")])
    one = [*TEAM, "player"]
    told = rows.groupingSets([one, [*one, "position_group"], [*one, "position"]], *one, "position_group", "position").agg(F.sum("guessed").alias("guessed"), F.sum("real").alias("real"), F.grouping("position_group").alias("_g"), F.grouping("position").alias("_p"))
    level = F.when(c("_p") == 0, "position").when(c("_g") == 0, "group").otherwise("player")
    games = truth.select("game", *TEAM).distinct().groupBy(*TEAM).agg(F.count("*").alias("_games"))
    size = sum(((c("_games") >= bound).cast("int") for bound in sizes), F.lit(0))
    binned = told.join(games, TEAM).withColumns({"level": level, "era": F.width_bucket("season", F.lit(eras[0]), F.lit(eras[1]), F.lit(eras[2])).cast("int"), "size": size})
    matched = F.sum(F.least("guessed", "real"))
    return binned.groupBy("level", "era", "size").agg(matched.alias("matched"), F.sum("real").alias("real"), (1 - F.try_divide(matched, F.sum("real"))).alias("set_miss_rate"))


def lines(assigned: DataFrame, stats: list[str]) -> DataFrame:
    """Line tables of an assignment, their stats unknown."""
    return assigned.select("*", *[F.lit(None).cast("int").alias(c) for c in stats])


def credit_split(df: DataFrame, event: str, current: str, charged: Column, runs: str) -> DataFrame:
    """Runs of a play by holder: one row where the charged holder is the current one, else one each (runs and bequeathed, inherited)."""
    same = charged == F.col(current)
    own = F.struct(charged.alias("holder"), F.col(runs).alias("runs"), F.when(same, 0).otherwise(F.col(runs)).alias("bequeathed"), F.lit(0).alias("inherited"))
    other = F.struct(F.col(current).alias("holder"), F.lit(0).alias("runs"), F.lit(0).alias("bequeathed"), F.col(runs).alias("inherited"))
    cast = lambda s: s.cast("struct<holder:bigint,runs:int,bequeathed:int,inherited:int>")
    rows = df.select(event, F.explode(F.when(same, F.array(cast(own))).otherwise(F.array(cast(own), cast(other)))).alias("x")).select(event, "x.*")
    return rows.groupBy(event, "holder").agg(*[F.sum(c).alias(c) for c in ("runs", "bequeathed", "inherited")])
