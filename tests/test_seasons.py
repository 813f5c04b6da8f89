"""Results of teams and standings where days or games come together."""

from datetime import date
from types import SimpleNamespace

from playmill.models import seasons


def info(spark, rows):
    kinds = "game_id long, team_id int, team_side string, league string, division string, opponent_league string, opponent_division string, season_game_number int, is_interleague boolean, opponent_id int, season int, game_type string, team_name string"
    return spark.createDataFrame([(g, t, side, "AL", "East", "AL", "East", k, False, o, 2000, "RegularSeason", f"T{t}") for g, t, side, k, o in rows], kinds)


def results(spark, rows):
    kinds = "game_id long, season int, game_type string, game_finish_date date, winning_team_id int, losing_team_id int, home_runs_scored long, away_runs_scored long, duration_outs long"
    return spark.createDataFrame([(g, 2000, "RegularSeason", day, w, l, 3, 2, 54) for g, day, w, l in rows], kinds)


def test_a_game_with_two_results_has_one_order(spark):
    sides = info(spark, [(g, t, side, g, 3 - t) for g in (1, 2, 3) for t, side in ((1, "Home"), (2, "Away"))])
    games = [(1, date(2000, 5, 1), 1, 2), (2, date(2000, 5, 2), 1, 2), (2, date(2000, 5, 2), 2, 1), (3, date(2000, 5, 3), 1, 2)]
    got = []
    for rows in (games, games[::-1]):
        m = SimpleNamespace(team_game_start_info=sides, game_results=results(spark, rows).coalesce(1))
        got.append(sorted(map(repr, seasons.team_game_results(m).collect())))
    assert got[0] == got[1] and len(got[0]) == 8


def test_a_table_that_begins_with_games_has_them(spark):
    days = [date(2000, 1, 1), date(2000, 1, 1), date(2000, 1, 3)]
    sides = info(spark, [(g, t, side, g, 3 - t) for g in (1, 2, 3) for t, side in ((1, "Home"), (2, "Away"))])
    m = SimpleNamespace(team_game_start_info=sides, game_results=results(spark, [(g, day, 1, 2) for g, day in enumerate(days, 1)]))
    m.team_game_results = seasons.team_game_results(m)
    got = {(r["team_id"], r["date"].day): r for r in seasons.standings(m).collect()}
    assert seasons.standings(m).count() == len(got) == 8
    for (team, day), r in got.items():
        n = sum(d.day <= day for d in days)
        assert (r["wins"], r["losses"]) == ((n, 0) if team == 1 else (0, n))
        assert (r["win_streak_length"], r["loss_streak_length"]) == (r["wins"], r["losses"]) == (r["last_10_wins"], r["last_10_losses"])
