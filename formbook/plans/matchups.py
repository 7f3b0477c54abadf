"""Registered queries of whole matchup tables: ten steps from pitches to one row a game, with relief load, venue, recent form and sky."""

from __future__ import annotations

from pyspark.sql import functions as F

from formbook.functions import features as X
from formbook.functions import scalars as S
from formbook.operators import matchups as M
from formbook.plans.assembled import CASES, weights
from formbook.plans.catalog import P, pitches, r6, register

BATTING = ["lineup_woba_vs_hand", "lineup_k_pct_vs_hand", "lineup_bb_pct_vs_hand", "top3_woba_vs_hand", "middle4_woba_vs_hand", "bottom2_woba_vs_hand", "pct_same_hand", "h2h_woba", "h2h_k_pct", "h2h_hr_rate"]
DIFFERENCES = ["lineup_woba_differential", "starter_woba_differential", "matchup_advantage_home", "h2h_woba_differential", "lineup_k_pct_differential"]

#: Starters, lineups and careers: sums of days before a game's day, by inequality on days.
STEPS = f"""{P}, st AS (SELECT game_date, game_pk, inning_topbot, pitcher, max(p_throws) AS p_throws FROM p WHERE inning <= 3 GROUP BY 1, 2, 3, 4 QUALIFY row_number() OVER (PARTITION BY game_date, game_pk, inning_topbot ORDER BY count(*) DESC, pitcher) = 1),
 lu AS (SELECT game_date, game_pk, inning_topbot, batter, arg_min(stand, pitch_id) AS stand, row_number() OVER (PARTITION BY game_date, game_pk, inning_topbot ORDER BY min(pitch_id), batter) AS slot FROM p WHERE batter IS NOT NULL GROUP BY 1, 2, 3, 4 QUALIFY slot <= 9),
 dy AS (SELECT batter, pitcher, p_throws, game_date, count(*) AS pa, sum((events = 'strikeout')::INT) AS k, sum((events = 'walk')::INT) AS bb, sum((events = 'home_run')::INT) AS hr, sum({CASES}) AS num FROM p WHERE batter IS NOT NULL AND events IS NOT NULL GROUP BY 1, 2, 3, 4),
 fc AS (SELECT lu.*, st.pitcher, st.p_throws FROM lu JOIN st USING (game_date, game_pk, inning_topbot)),
 hc AS (SELECT fc.batter, fc.p_throws, fc.game_date, sum(pa) AS pa, sum(k) AS k, sum(bb) AS bb, sum(num) AS num FROM (SELECT DISTINCT batter, p_throws, game_date FROM fc) fc JOIN dy ON dy.batter = fc.batter AND dy.p_throws = fc.p_throws AND dy.game_date < fc.game_date GROUP BY 1, 2, 3),
 bc AS (SELECT fc.batter, fc.pitcher, fc.game_date, sum(pa) AS pa, sum(k) AS k, sum(hr) AS hr, sum(num) AS num FROM (SELECT DISTINCT batter, pitcher, game_date FROM fc) fc JOIN dy ON dy.batter = fc.batter AND dy.pitcher = fc.pitcher AND dy.game_date < fc.game_date GROUP BY 1, 2, 3),
 sc AS (SELECT st.pitcher, st.game_date, sum(pa) AS pa, sum(k) AS k, sum(num) AS num FROM (SELECT DISTINCT pitcher, game_date FROM st) st JOIN dy ON dy.pitcher = st.pitcher AND dy.game_date < st.game_date GROUP BY 1, 2)"""


def _rate(of: str, alias: str, ok: str) -> str:
    scale = " / 1000.0::DOUBLE" if of == "num" else ""
    return f"sum({alias}.{of}) FILTER ({ok}) / nullif(sum({alias}.pa) FILTER ({ok}), 0)::DOUBLE{scale}"


TABLE = f"""{STEPS}, s AS (SELECT game_date, game_pk, inning_topbot, fc.pitcher, fc.p_throws, {_rate("num", "h", "h.pa >= 20")} AS lineup_woba_vs_hand, {_rate("k", "h", "h.pa >= 20")} AS lineup_k_pct_vs_hand, {_rate("bb", "h", "h.pa >= 20")} AS lineup_bb_pct_vs_hand,
 {_rate("num", "h", "h.pa >= 20 AND slot <= 3")} AS top3_woba_vs_hand, {_rate("num", "h", "h.pa >= 20 AND slot BETWEEN 4 AND 7")} AS middle4_woba_vs_hand, {_rate("num", "h", "h.pa >= 20 AND slot >= 8")} AS bottom2_woba_vs_hand, avg((stand = fc.p_throws)::INT) AS pct_same_hand, sum(coalesce(b.pa, 0))::BIGINT AS h2h_pa_total,
 {_rate("num", "b", "b.pa >= 5")} AS h2h_woba, {_rate("k", "b", "b.pa >= 5")} AS h2h_k_pct, {_rate("hr", "b", "b.pa >= 5")} AS h2h_hr_rate FROM fc LEFT JOIN hc h USING (batter, p_throws, game_date) LEFT JOIN bc b ON b.batter = fc.batter AND b.pitcher = fc.pitcher AND b.game_date = fc.game_date GROUP BY 1, 2, 3, 4, 5),
 q AS (SELECT s.*, CASE WHEN sc.pa >= 20 THEN sc.num / sc.pa::DOUBLE / 1000.0::DOUBLE ELSE 0.32 END AS allowed, CASE WHEN sc.pa >= 20 THEN sc.k / sc.pa::DOUBLE ELSE 0.2 END AS kp FROM s LEFT JOIN sc USING (pitcher, game_date)),
 h AS (SELECT * FROM q WHERE inning_topbot = 'Bot'), a AS (SELECT * FROM q WHERE inning_topbot = 'Top'),
 j AS (SELECT h.game_date, h.game_pk, {", ".join(f"{x}.{c} AS {n}_{c}" for x, n in (("h", "home"), ("a", "away")) for c in [*BATTING, "h2h_pa_total"])}, a.pitcher AS home_starter_id, a.p_throws AS home_starter_hand, a.allowed AS home_starter_woba_allowed, a.kp AS home_starter_k_pct, h.pitcher AS away_starter_id, h.p_throws AS away_starter_hand, h.allowed AS away_starter_woba_allowed, h.kp AS away_starter_k_pct FROM h JOIN a USING (game_date, game_pk)),
 m AS (SELECT *, coalesce(home_lineup_woba_vs_hand, 0.32) AS hl, coalesce(away_lineup_woba_vs_hand, 0.32) AS al FROM j),
 w AS (SELECT *, hl - al AS lineup_woba_differential, away_starter_woba_allowed - home_starter_woba_allowed AS starter_woba_differential, (3 * hl + 2 * coalesce(home_h2h_woba, hl) + 1.5 * coalesce(home_top3_woba_vs_hand, hl) - 3 * al - 2 * coalesce(away_h2h_woba, al) - 1.5 * coalesce(away_top3_woba_vs_hand, al) - 2 * home_starter_woba_allowed + 2 * away_starter_woba_allowed) / 15.0::DOUBLE / 0.15::DOUBLE AS matchup_advantage_home,
 coalesce(home_h2h_woba, 0.32) - coalesce(away_h2h_woba, 0.32) AS h2h_woba_differential, coalesce(away_lineup_k_pct_vs_hand, 0.2) - coalesce(home_lineup_k_pct_vs_hand, 0.2) AS lineup_k_pct_differential FROM m)"""
ROUNDED = [f"{side}_{c}" for side in ("home", "away") for c in [*BATTING, "starter_woba_allowed", "starter_k_pct"]] + DIFFERENCES
KEPT = [f"{side}_{c}" for side in ("home", "away") for c in ("h2h_pa_total", "starter_id", "starter_hand")]


@register(f"WITH {TABLE} SELECT game_date, game_pk, {', '.join(KEPT)}, {', '.join(f'round({c}, 6) + 0.0::DOUBLE AS {c}' for c in ROUNDED)} FROM w")
def m5_matchup_table(spark, d):
    """Ten steps: starters, lineups, careers against a hand, of a starter and of a pairing before the day, sides, pivot, defaults, differences."""
    t = M.table(pitches(spark, d), weights())
    return t.select("game_date", "game_pk", *KEPT, *[(F.round(c, 6) + 0.0).alias(c) for c in ROUNDED])


BULLPEN = f"""{P}, u AS (SELECT pitcher % 10 AS team, game_date, count(*) AS n, count(DISTINCT pitcher) AS who, count(DISTINCT (game_pk, inning)) AS inn FROM p WHERE inning > 1 GROUP BY 1, 2),
 l AS (SELECT u.team, u.game_date, coalesce(sum(v.n), 0)::BIGINT AS pitches, coalesce(sum(v.who), 0)::BIGINT AS appearances, coalesce(sum(v.inn), 0)::BIGINT AS innings, coalesce(sum(v.n * (8 - (u.game_date - v.game_date))), 0) / 7.0::DOUBLE AS fatigue FROM u LEFT JOIN u v ON v.team = u.team AND u.game_date - v.game_date BETWEEN 1 AND 7 GROUP BY 1, 2),
 lt AS (SELECT pitcher % 10 AS team, pitcher, game_date, count(*) AS n FROM p WHERE inning >= 9 GROUP BY 1, 2, 3), tt AS (SELECT *, sum(n) OVER (PARTITION BY team, pitcher ORDER BY game_date) AS total FROM lt),
 cl AS (SELECT l.*, tt.pitcher AS closer, (l.game_date - tt.game_date)::INT AS closer_rest FROM l LEFT JOIN tt ON tt.team = l.team AND tt.game_date < l.game_date QUALIFY row_number() OVER (PARTITION BY l.team, l.game_date ORDER BY tt.total DESC NULLS LAST, tt.pitcher, tt.game_date DESC) = 1)"""


@register(f"WITH {BULLPEN} SELECT team, game_date, pitches, appearances, innings, round(fatigue, 6) AS fatigue, closer, closer_rest FROM cl")
def m7_bullpen_load(spark, d):
    """Relief load of the week before, weighed by how long ago it was, and the rest of the closer."""
    b = M.bullpen(pitches(spark, d), F.col("pitcher") % 10)
    return b.select("team", "game_date", "pitches", "appearances", "innings", r6(F.col("fatigue"), "fatigue"), "closer", "closer_rest")


@register()
def m7_matchup_row(spark, d):
    """The matchup table with relief load of both sides, both lineups and starters at the venue, starters' and lineups' recent form, arsenal and sky."""
    p, c = pitches(spark, d), F.col
    base = M.table(p, weights())
    load = M.bullpen(p, c("pitcher") % 10)
    venue = M.sided(M.at_venue(p, weights(), c("game_pk") % 30), ["starter_at_venue_woba", "lineup_at_venue_woba"], "top", "bottom")
    form = M.recent(p, weights(), "pitcher", 30, 180)
    met = M.joined([base.join(p.select("game_date", "game_pk", (c("game_pk") % 10).alias("home_team"), ((c("game_pk") + 1) % 10).alias("away_team")).distinct(), M.GAME), venue])
    for side in ("home", "away"):
        own = load.select(c("team").alias(f"{side}_team"), "game_date", c("pitches").alias(f"{side}_bullpen_pitches_7d"), c("fatigue").alias(f"{side}_bullpen_fatigue_score"), c("closer_rest").alias(f"{side}_closer_days_rest"))
        arm = form.select(c("pitcher").alias(f"{side}_starter_id"), "game_date", c("velocity").alias(f"{side}_starter_velocity_30d"), c("woba").alias(f"{side}_starter_woba_30d"))
        met = met.join(own, [f"{side}_team", "game_date"], "left").join(arm, [f"{side}_starter_id", "game_date"], "left")
    quality = lambda side: X.arsenal_quality(c(f"{side}_starter_k_pct"), F.coalesce(f"{side}_starter_woba_30d", f"{side}_starter_woba_allowed"), F.coalesce(f"{side}_starter_velocity_30d", F.lit(93.0)))
    # Who throws in the top half is the home side's starter; who bats there is the away side.
    names = {"top_starter_at_venue_woba": "home_starter_venue_woba", "bottom_starter_at_venue_woba": "away_starter_venue_woba", "top_lineup_at_venue_woba": "away_lineup_venue_woba", "bottom_lineup_at_venue_woba": "home_lineup_venue_woba"}
    more = {
        "bullpen_differential": c("away_bullpen_fatigue_score") - c("home_bullpen_fatigue_score"), "arsenal_advantage": quality("home") - quality("away"), "venue_differential": c("home_lineup_venue_woba") - c("away_lineup_venue_woba"),
        "moon_illumination": S.moon_illumination(c("game_date")), "month": F.month("game_date"), "is_weekend": (F.weekday("game_date") >= 5).cast("int"),
    }
    return met.withColumnsRenamed(names).withColumns(more)


def _window(of: str, by: str, days: int) -> str:
    return f"sum({of}) OVER (PARTITION BY {by} ORDER BY game_date RANGE BETWEEN INTERVAL {days} DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)"


def _recent(of: str, per: str) -> str:
    return f"coalesce({_window(of, 'pitcher', 30)} / nullif({_window(per, 'pitcher', 30)}, 0)::DOUBLE, {_window(of, 'pitcher', 180)} / nullif({_window(per, 'pitcher', 180)}, 0)::DOUBLE)"


@register(
    f"""WITH {STEPS}, d AS (SELECT pitcher, game_date, sum(round(release_speed * 100)) AS s, count(release_speed) AS n, count(events) AS pa, sum({CASES}) AS num, sum((events = 'strikeout')::INT) - sum((events = 'walk')::INT) AS kbb FROM p GROUP BY 1, 2),
 rc AS (SELECT pitcher, game_date, {_recent("s", "n")} / 100.0::DOUBLE AS velocity, {_recent("num", "pa")} / 1000.0::DOUBLE AS woba, {_recent("kbb", "pa")} AS kbb FROM d),
 q AS (SELECT st.*, velocity, woba, kbb, 2 * coalesce(kbb, 0.1) - coalesce(woba, 0.32) + 0.05 * (coalesce(velocity, 93.0) - 93) / 3 AS quality FROM st LEFT JOIN rc USING (pitcher, game_date)),
 bd AS (SELECT batter, game_pk % 30 AS venue, game_date, count(*) AS pa, sum({CASES}) AS num FROM p WHERE batter IS NOT NULL AND events IS NOT NULL GROUP BY 1, 2, 3),
 vb AS (SELECT l.batter, l.venue, l.game_date, sum(bd.pa) AS pa, sum(bd.num) AS num FROM (SELECT DISTINCT batter, game_pk % 30 AS venue, game_date FROM lu) l JOIN bd ON bd.batter = l.batter AND bd.venue = l.venue AND bd.game_date < l.game_date GROUP BY 1, 2, 3),
 cb AS (SELECT l.batter, l.game_date, sum(bd.pa) AS pa, sum(bd.num) AS num FROM (SELECT DISTINCT batter, game_date FROM lu) l JOIN bd ON bd.batter = l.batter AND bd.game_date < l.game_date GROUP BY 1, 2),
 lf AS (SELECT lu.game_date, lu.game_pk, lu.inning_topbot, sum((vb.num / vb.pa::DOUBLE - cb.num / cb.pa::DOUBLE) / 1000.0::DOUBLE * vb.pa) FILTER (vb.pa >= 3) / sum(vb.pa) FILTER (vb.pa >= 3) AS lift FROM lu LEFT JOIN vb ON vb.batter = lu.batter AND vb.venue = lu.game_pk % 30 AND vb.game_date = lu.game_date LEFT JOIN cb ON cb.batter = lu.batter AND cb.game_date = lu.game_date GROUP BY 1, 2, 3),
 a AS (SELECT * FROM q WHERE inning_topbot = 'Top'), h AS (SELECT * FROM q WHERE inning_topbot = 'Bot')
 SELECT a.game_date, a.game_pk, a.pitcher AS home_starter_id, h.pitcher AS away_starter_id, round(a.velocity, 6) AS home_starter_velocity, round(h.velocity, 6) AS away_starter_velocity, round(a.kbb, 6) AS home_starter_k_bb, round(h.kbb, 6) AS away_starter_k_bb, round(a.woba, 6) AS home_starter_xwoba, round(h.woba, 6) AS away_starter_xwoba,
 round(a.quality - h.quality, 6) + 0.0::DOUBLE AS arsenal_advantage, round(lh.lift, 6) AS home_venue_lift, round(la.lift, 6) AS away_venue_lift, round(coalesce(lh.lift, 0) - coalesce(la.lift, 0), 6) + 0.0::DOUBLE AS venue_woba_differential
 FROM a JOIN h USING (game_date, game_pk) LEFT JOIN lf la ON la.game_date = a.game_date AND la.game_pk = a.game_pk AND la.inning_topbot = 'Top' LEFT JOIN lf lh ON lh.game_date = a.game_date AND lh.game_pk = a.game_pk AND lh.inning_topbot = 'Bot'"""
)
def m6_arsenal_table(spark, d):
    """Starters' arsenal over the 30 days before (180 where there are none), and how much better each lineup hit at the venue before than everywhere."""
    p, c = pitches(spark, d), F.col
    # Speeds as whole hundredths: their sums are exact in any order.
    form = M.recent(p.withColumn("release_speed", F.round(c("release_speed") * 100)), weights(), "pitcher", 30, 180).withColumn("velocity", c("velocity") / 100.0)
    arms = M.sided(M.starters(p).join(form, ["pitcher", "game_date"], "left"), ["pitcher", "velocity", "kbb", "woba"], "home", "away").where("home_pitcher IS NOT NULL AND away_pitcher IS NOT NULL")
    lift = M.sided(M.venue_lift(p, weights(), c("game_pk") % 30), ["venue_lift"], "away", "home")
    met = M.joined([arms, lift])
    quality = lambda side: X.arsenal_quality(F.coalesce(f"{side}_kbb", F.lit(0.1)), F.coalesce(f"{side}_woba", F.lit(0.32)), F.coalesce(f"{side}_velocity", F.lit(93.0)))
    names = {"pitcher": "starter_id", "velocity": "starter_velocity", "kbb": "starter_k_bb", "woba": "starter_xwoba"}
    shown = [(c(f"{side}_{a}") if a == "pitcher" else F.round(c(f"{side}_{a}"), 6)).alias(f"{side}_{b}") for side in ("home", "away") for a, b in names.items()]
    zero = lambda side: F.coalesce(f"{side}_venue_lift", F.lit(0.0))
    return met.select("game_date", "game_pk", *shown, (F.round(quality("home") - quality("away"), 6) + 0.0).alias("arsenal_advantage"), *[r6(c(f"{side}_venue_lift"), f"{side}_venue_lift") for side in ("home", "away")], (F.round(zero("home") - zero("away"), 6) + 0.0).alias("venue_woba_differential"))
