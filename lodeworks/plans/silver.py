"""Bronze -> silver and quarantine for any contract."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from lodeworks.contract import Contract
from lodeworks.operators.audit import SILVER_TS, SOURCE_FILE, stamp
from lodeworks.operators.clean import (
    blank_null_tokens,
    drop_columns,
    enforce_types,
    parse_game_time,
    tidy_text,
)
from lodeworks.operators.dedup import keep_latest
from lodeworks.operators.derive import derive
from lodeworks.operators.quality import (
    accepted,
    quarantined,
    require_columns,
    with_policy,
)


@dataclass(frozen=True)
class SilverTables:
    silver: DataFrame
    quarantine: DataFrame


def _as_date(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def _as_timestamp(run_ts: datetime | None) -> Column:
    return F.current_timestamp() if run_ts is None else F.lit(run_ts)


def _tidied(df: DataFrame, contract: Contract) -> DataFrame:
    return tidy_text(df, contract.trim, contract.upper, contract.initcap)


def clean(bronze: DataFrame, contract: Contract) -> DataFrame:
    """Null tokens, types, text and timestamps; row count unchanged."""
    require_columns(bronze, contract.bronze.fieldNames())
    carry = [name for name in (SOURCE_FILE,) if name in bronze.columns]
    untouched = [*contract.keep_tokens_in, *carry]
    if contract.enforce_types:
        # No token reads as a number, so the cast alone turns it into NULL.
        untouched += [f.name for f in contract.bronze.fields if f.dataType != StringType()]
    df = blank_null_tokens(bronze, except_columns=untouched)
    if contract.enforce_types:
        df = enforce_types(df, contract.bronze, carry)
    if not contract.tidy_text_after_checks:
        df = _tidied(df, contract)
    if contract.timestamp_from:
        df = parse_game_time(df, contract.timestamp_from, contract.timestamp_to)
    return df


def tie_break_columns(df: DataFrame, contract: Contract) -> list[str]:
    """Bronze columns (then lineage) that complete the dedup order.

    With them the surviving row is determined up to exact duplicates.
    """
    ranked = {name.lower() for name in (*contract.latest.keys, *contract.latest.newest_by)}
    rest = [name for name in contract.bronze.fieldNames() if name.lower() not in ranked]
    return rest + [name for name in (SOURCE_FILE,) if name in df.columns]


def build_silver(
    bronze: DataFrame,
    contract: Contract,
    *,
    as_of: date | None = None,
    run_ts: datetime | None = None,
    on_invalid: str | None = None,
    on_unknown: str | None = None,
    tie_break: Sequence[str] | None = None,
) -> SilverTables:
    """Lazily build both outputs of a contract.

    ``on_invalid`` and ``on_unknown`` override where failing and undecidable
    rows go. With both set to ``"quarantine"`` every bronze row is in silver, in
    quarantine, or an older duplicate of a silver row.
    """
    today, now = _as_date(as_of), _as_timestamp(run_ts)
    checks = with_policy(contract.checks, on_invalid, on_unknown)
    prepared = derive(clean(bronze, contract), contract.before_checks, today)

    good = accepted(prepared, checks, today)
    if contract.tidy_text_after_checks:
        good = _tidied(good, contract)
    if tie_break is None:
        tie_break = tie_break_columns(good, contract)
    newest = keep_latest(good, contract.latest.keys, contract.latest.newest_by, tie_break)
    enriched = drop_columns(derive(newest, contract.after_dedup, today), contract.drop)

    return SilverTables(
        silver=stamp(enriched, (SILVER_TS, SOURCE_FILE), now, contract.record_source),
        quarantine=stamp(
            quarantined(prepared, checks, today), contract.quarantine_audit, now, contract.record_source
        ),
    )
