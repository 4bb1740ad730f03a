"""Point-in-time replay: signals for every decision at once, outcomes, and the leakage audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions import constants
from tapeline.functions.hashing import content_hash
from tapeline.operators import asof
from tapeline.operators.channels import STANDARD_CHANNELS, Channel, channel_picks, channel_scores, consensus, eligible_counts
from tapeline.operators.features import replay_features
from tapeline.operators.scaling import percentile_ranks

RANKS = (
    ("ret5", "ret5_pct_rank", False),
    ("liquidity_proxy", "liquidity_proxy_pct_rank", False),
    ("atr5", "atr5_pct_rank", True),
)
OUTCOME_COLUMNS = ("next_open_return", "next_high_return", "next_close_return", "next_low_return")


@dataclass
class Signals:
    decisions: DataFrame
    features: DataFrame
    scores: DataFrame
    picks: DataFrame
    consensus: DataFrame
    eligible: DataFrame


def market_sessions(bars: DataFrame) -> DataFrame:
    return bars.select("session", "session_no").distinct()


Stage = Callable[[DataFrame, str], DataFrame]


def _lazy(df: DataFrame, label: str) -> DataFrame:
    return df


def ranked_panel(bars: DataFrame, stage: Stage = _lazy) -> DataFrame:
    """Tradable features of every as-of session with cross-sectional ranks; suspended codes keep their last row."""
    last = bars.groupBy().agg(F.max("session_no"))
    panel = stage(asof.as_of_panel(replay_features(bars), last.scalar()).where("is_tradable"), "panel")
    return percentile_ranks(panel, ["as_of_no"], ["code"], RANKS)


def decision_features(
    bars: DataFrame, messages: DataFrame, positive: Sequence[str] = constants.POSITIVE_WORDS, risk: Sequence[str] = constants.RISK_WORDS,
    stage: Stage = _lazy,
) -> tuple[DataFrame, DataFrame]:
    """(decisions, features with event counters). Ranks are taken per as-of session and shared by both modes."""
    decided = stage(asof.decisions(market_sessions(bars)), "decisions")
    panel = ranked_panel(bars, stage)
    names = bars.select("code", "name").distinct()
    ann, news = asof.event_counters(messages, names, decided, positive, risk)
    rows = panel.join(decided.select("mode", "decision_no", "decision_date", "as_of_no"), "as_of_no")
    return decided, asof.with_events(rows, ann, news)


def generate_signals(
    bars: DataFrame, messages: DataFrame, channels: Sequence[Channel] = STANDARD_CHANNELS,
    positive: Sequence[str] = constants.POSITIVE_WORDS, risk: Sequence[str] = constants.RISK_WORDS, stage: Stage = _lazy,
) -> Signals:
    """All signals of all decisions. ``stage`` may store the panel and the decisions, which several steps read; pass
    ``tapeline.session.staged`` to compute each once."""
    decided, features = decision_features(bars, messages, positive, risk, stage)
    scores = channel_scores(features, channels)
    picks = channel_picks(scores)
    return Signals(decided, features, scores, picks, consensus(picks), eligible_counts(scores))


def decision_table(signals: Signals, messages: DataFrame) -> DataFrame:
    """One row per decision: cutoffs, visible message counts, cross-section size and eligible counts per channel."""
    seen = asof.visible_messages(messages.select("kind", "stamp"), signals.decisions).groupBy("mode", "decision_no").agg(
        F.count_if(F.col("kind") == "news").alias("visible_news_count"),
        F.count_if(F.col("kind") == "announcement").alias("visible_announcement_count"),
        F.max("stamp").alias("visible_message_max"),
    )
    size = signals.features.groupBy("mode", "decision_no").agg(F.count(F.lit(1)).alias("feature_stock_count"))
    eligible = signals.eligible.groupBy("mode", "decision_no").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("channel", "eligible")))).alias("eligible_counts")
    )
    key = ["mode", "decision_no"]
    out = signals.decisions.join(seen, key, "left").join(size, key, "left").join(eligible, key, "left")
    return out.fillna(0, ["visible_news_count", "visible_announcement_count", "feature_stock_count"])


def sealed(picks: DataFrame) -> DataFrame:
    """Picks with their content hash, to be stored before any outcome is known."""
    return picks.withColumn("seal_sha256", content_hash(picks))


def evaluate(signals_picks: DataFrame, signals_consensus: DataFrame, bars: DataFrame) -> DataFrame:
    """Outcomes of every channel's best pick and of the two best consensus codes."""
    key = ["mode", "decision_no", "code"]
    first = signals_picks.where("rank = 1").select(*key, F.col("channel").alias("group"))
    agreed = signals_consensus.where("rank <= 2").select(*key, F.concat(F.lit("CONSENSUS_R"), F.col("rank").cast("string")).alias("group"))
    last = bars.groupBy().agg(F.max("session_no"))
    return asof.next_session_outcomes(first.unionByName(agreed), bars, last.scalar())


def visible_maxima(messages: DataFrame, decisions: DataFrame) -> DataFrame:
    """(mode, decision_no, latest): the newest message that each decision saw, to be stored with its signals."""
    return asof.visible_messages(messages.select("stamp"), decisions).groupBy("mode", "decision_no").agg(F.max("stamp").alias("latest"))


def leakage_audit(decisions: DataFrame, maxima: DataFrame, sealed_picks: DataFrame) -> DataFrame:
    """Violations in stored signals, empty when the replay is clean.

    ``decisions``: mode, decision_no, cutoff and the stored as_of_no; ``maxima``: what ``visible_maxima`` stored; ``sealed_picks``:
    what ``sealed`` stored. All three are audited as they are found.
    """
    late = maxima.join(decisions.select("mode", "decision_no", "cutoff"), ["mode", "decision_no"]).where(F.col("latest") > F.col("cutoff"))
    late = late.select("mode", "decision_no", F.lit("future message").alias("violation"))
    anchor = decisions.where(
        ((F.col("mode") == "morning") & (F.col("as_of_no") >= F.col("decision_no")))
        | ((F.col("mode") == "overnight") & (F.col("as_of_no") != F.col("decision_no")))
    ).select("mode", "decision_no", F.lit("wrong market anchor").alias("violation"))
    body = [c for c in sealed_picks.columns if c != "seal_sha256"]
    broken = sealed_picks.where(F.col("seal_sha256") != content_hash(sealed_picks, body)).select(
        "mode", "decision_no", F.lit("seal mismatch").alias("violation")
    )
    out = late.unionByName(anchor).unionByName(broken)
    for c in OUTCOME_COLUMNS:
        if c in sealed_picks.columns:
            out = out.unionByName(sealed_picks.select("mode", "decision_no", F.lit(f"outcome column {c}").alias("violation")).distinct())
    return out
