"""Pipelines composed of the operators, from plays to games, players and seasons. Inputs are frames with the columns named."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import project as P
from ..operators import sets as S
from ..operators import windows as W

BATTING = {"hits": ["purchase", "signup"], "walks": ["click"], "outs": ["error"]}


def event_batting_stats(plays: DataFrame) -> DataFrame:
    """Counters of each play from its result: play, game, holder, and one 0/1 column a stat."""
    flags = {n: P.flag(F.col("result").isin(kinds)) for n, kinds in BATTING.items()}
    on_base = (flags["hits"] + flags["walks"]).alias("on_base_successes")
    return plays.select("play", "game", "holder", F.lit(1).alias("plate_appearances"), *[c.alias(n) for n, c in flags.items()], on_base, F.col("runs_on_play").alias("runs"))


def event_base_out_states(plays: DataFrame) -> DataFrame:
    """State before and after each play, both sides' scores, and whether it opens or ends its half."""
    w = W.over(["game", "inning", "away"], ["event_id"])
    start, end = W.running_by_side(F.col("runs_on_play"), F.col("away"), ["game"], ["event_id"])
    return plays.select(
        "play", "base_state", F.lead("base_state").over(w).alias("base_state_end"), F.bit_count("base_state").cast("int").alias("runners"), start.alias("away_start"), end.alias("away_end"),
        F.lag("play").over(w).isNull().alias("opens"), F.lead("play").over(w).isNull().alias("ends"), W.rest_of_group(F.col("runs_on_play"), ["game", "inning", "away"], ["event_id"]).alias("rest_of_half"),
    )


def fielding_chains(plays: DataFrame) -> DataFrame:
    """Per game and fielder: putouts, assists (chains assisted in), errors, and putouts in chains with an assist."""
    closing = F.col("result").isin("purchase", "error")
    chained = W.chain_groups(plays, ["game"], ["event_id"], closing)
    helped = F.max(P.flag(F.col("result") == "click")).over(W.over(["game", "chain"]))
    marked = chained.withColumn("_helped", helped)
    return marked.groupBy("game", "holder").agg(
        F.count_if(F.col("result") == "purchase").alias("putouts"), F.count_distinct(F.when(F.col("result") == "click", F.col("chain"))).alias("assists"),
        F.count_if(F.col("result") == "error").alias("errors"), F.count_if((F.col("result") == "purchase") & (F.col("_helped") == 1)).alias("assisted_putouts"),
    )


def player_fan_out(plays: DataFrame, fielders: int = 4) -> DataFrame:
    """A row for each play and fielder on the field, credited if the play is theirs."""
    every = plays.select("play", "holder", "outs_on_play", F.explode(F.sequence(F.lit(0), F.lit(fielders - 1))).alias("fielder"))
    mine = P.flag(F.col("holder") == F.col("fielder"))
    return every.groupBy("fielder").agg(F.count("*").alias("plays"), F.sum(mine).alias("own_plays"), F.sum(mine * F.col("outs_on_play")).alias("own_outs"), F.sum("outs_on_play").alias("outs"))


def player_game_stats(plays: DataFrame, summaries: DataFrame) -> DataFrame:
    """Stats by player and game: from plays where a game has them, else from summary lines; the two accounts have no game in common."""
    stats = ["plate_appearances", *BATTING, "runs"]
    own = A.rollup_sum(event_batting_stats(plays), ["game", "holder"], stats)
    rest = summaries.join(plays.select("game").distinct(), "game", "left_anti")
    return own.unionByName(rest, allowMissingColumns=True)


def player_season_stats(primary: DataFrame, other: DataFrame, keys: list[str], stats: list[str], season: str, trusted_before: int) -> DataFrame:
    """Fills what the primary table lacks, replaces early seasons by the trusted table, then adds what only that one has."""
    filled = P.supplement(primary, other, keys, stats, F.lit(True))
    settled = P.override(filled, other, keys, stats, F.col(season) < trusted_before)
    return settled.unionByName(J.without(other.select(*settled.columns), primary, keys))


def team_game_results(games: DataFrame) -> DataFrame:
    """Each team's games in order with record to date, streak, days of rest and last ten."""
    keys, order = ["team", "season"], ["day", "game"]
    numbered = games.withColumn("number", F.row_number().over(W.over(keys, order)))
    run = W.streaks(numbered, keys, order, F.col("win"), "number")
    w, to_date = W.over(keys, order), W.over(keys, order, (W.FIRST, W.NOW))
    return run.select(
        "game", "team", "season", "number", F.sum(F.col("win").cast("int")).over(to_date).alias("wins"), F.sum((~F.col("win")).cast("int")).over(to_date).alias("losses"), "streak_length",
        F.datediff("day", F.lag("day").over(w)).alias("rest"), F.sum(F.col("win").cast("int")).over(W.over(keys, ["number"], ranges=(-9, 0))).alias("last_10"),
    )


def people(parts: list[DataFrame], key: str, name: str) -> DataFrame:
    """One row a person from several registers, with the register-wise most frequent name; ids of digits only."""
    names = parts[0].select(key, name)
    for p in parts[1:]:
        names = names.union(p.select(key, name))
    ids = J.full_outer([p.select(key).distinct().withColumn(f"in_{k}", F.lit(True)) for k, p in enumerate(parts)], [key])
    known = A.mode(names, [key], name)
    return P.zero_fill(ids.withColumns({f"in_{k}": P.flag(F.col(f"in_{k}")) for k in range(len(parts))}), []).join(known, key, "left").where(F.col(key).cast("string").rlike("^[0-9]+$"))


def line_scores(plays: DataFrame, innings: int = 8) -> DataFrame:
    """Runs by inning of each game and side as a text, two-figure innings in brackets, x for innings not played."""
    by = plays.groupBy("game", "away", "inning").agg(F.sum("runs_on_play").alias("r"))
    grid = by.select("game", "away").distinct().withColumn("inning", F.explode(F.sequence(F.lit(1), F.lit(innings))))
    r = F.col("r").cast("string")
    cell = F.when(F.col("r").isNull(), "x").when(F.col("r") > 9, F.concat(F.lit("("), r, F.lit(")"))).otherwise(r)
    return grid.join(by, ["game", "away", "inning"], "left").groupBy("game", "away").agg(A.ordered_text(cell, F.col("inning")).alias("line_score"))


def starting_lineups(appearances: DataFrame) -> DataFrame:
    """slot -> player of each team, slots that two players claim left out."""
    return W.drop_ambiguous(appearances, ["game", "slot"]).groupBy("game").agg(A.ordered_map(F.col("slot"), F.col("player")).alias("lineup"))


def count_rates(plays: DataFrame) -> DataFrame:
    """Hit rate by outs and base state with each row's share of its outs and of all plays."""
    by = plays.groupBy("outs", "base_state").agg(F.count("*").alias("n"), F.avg((F.col("result") == "purchase").cast("int")).alias("rate"))
    return W.grand_share(by.withColumn("share", W.share(F.col("n"), ["outs"])), "n", "of_all")


def leaders(players: DataFrame, k: int) -> DataFrame:
    """The k best of each season by hits, then id."""
    return S.topk_group(players, ["season"], [F.desc("hits"), "player"], k)
