"""Login events to log rows: client strings parsed, odd ones kept aside.

One projection of built-in expressions, so it has no shuffle and runs unchanged
on a batch or a stream.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import at, stamp14
from tidemark.functions.text import as_column, blank_to_null, position, split_fields
from tidemark.schemas import LOGIN_LOG

# The login type with a client string, and the patterns of known strings.
MOBILE = "M"
KNOWN_DEVICE = r"i[Pp]hone\s|i[Pp]od\s|i[Pp]ad\s|[Aa]ndroid\s|[Ww]indows mobile\s"
KNOWN_CLIENT = r"^Bugs\s"
CLIENT_PREFIX = "Bugs "
ANDROID = "[Aa]ndroid"
WINDOWS = "[Ww]indows mobile"
WINDOWS_NAME = "Windows mobile"
APPLE_DEVICE = "i[Pp]hone|i[Pp]od|i[Pp]ad"
CLOSED_VERSION = r"[0-9.]+\)"
APPLE_PLATFORM = "iOS"
APPLE = "Apple"
VERSION_CAP = 20
NAME_CAP = 50

PARSED = ("m_app_ver", "m_platform_nm", "m_platform_ver", "m_device_nm", "m_comp_nm", "m_device_no")


def is_mobile(login_type: Column | str) -> Column:
    return F.coalesce(as_column(login_type) == MOBILE, F.lit(False))


def valid_client(client: Column | str) -> Column:
    """The string names the client first and some known device; NULL does not."""
    client = as_column(client)
    return F.coalesce(client.rlike(KNOWN_CLIENT) & client.rlike(KNOWN_DEVICE), F.lit(False))


def parse_client(df: DataFrame, col: str = "sso", login_type: str | None = None) -> DataFrame:
    """Add the parsed columns; NULL where the string is not valid or not a mobile login.

    Each step is a projection of its own, so that what several columns need is
    computed once and the generated code stays small.
    """
    parse = valid_client(col)
    if login_type is not None:
        parse = parse & is_mobile(login_type)
    client = F.when(parse, F.col(col))

    def _match(pattern: str) -> Column:
        # '' without a match; the last step turns it into NULL
        return F.regexp_extract("__rest", pattern, 0)

    body, bracket, rest = F.col("__body"), F.col("__bracket"), F.col("__rest")
    platform, fields, version = F.col("__platform"), F.col("__fields"), F.col("__version")
    after_prefix = F.substring("__client", F.lit(len(CLIENT_PREFIX) + 1), F.length("__client"))
    steps: list[dict[str, Column]] = [
        {"__client": client},
        {"__prefixed": F.col("__client").startswith(CLIENT_PREFIX)},
        {
            "__body": F.replace(
                F.when(F.col("__prefixed"), after_prefix).otherwise(F.col("__client")),
                F.lit(", "),
                F.lit(","),
            )
        },
        {"__bracket": position(body, "(")},
        # a string with another blank after the prefix has no readable rest
        {"__rest": F.when(F.col("__prefixed"), F.substring(body, bracket + 1, F.length(body)))},
        {
            "__platform": F.when(rest.rlike(ANDROID), 1)
            .when(rest.rlike(WINDOWS), 2)
            .when(rest.rlike(APPLE_DEVICE), 3)
        },
        {
            "__fields": F.when(platform == 1, split_fields(F.replace(rest, F.lit(")"), F.lit("")))),
            "__version": F.when(platform > 1, _match(CLOSED_VERSION)),
        },
        {
            "m_app_ver": F.when(bracket > 2, F.substring(body, F.lit(1), bracket - 2)),
            "m_platform_nm": F.when(platform == 1, _match(ANDROID))
            .when(platform == 2, _match(WINDOWS_NAME))
            .when(platform == 3, F.lit(APPLE_PLATFORM)),
            "m_platform_ver": F.when(
                platform == 1,
                F.substring(F.regexp_replace(F.get(fields, 0), f"{ANDROID} ", ""), 1, VERSION_CAP),
            ).otherwise(F.replace(version, F.lit(")"), F.lit(""))),
            "m_device_nm": F.when(platform == 1, F.substring(F.get(fields, 1), 1, NAME_CAP)).when(
                platform == 3, _match(APPLE_DEVICE)
            ),
            "m_comp_nm": F.when(platform == 1, F.substring(F.get(fields, 2), 1, NAME_CAP)).when(
                platform == 3, F.lit(APPLE)
            ),
            "m_device_no": F.when(platform == 1, F.substring(F.get(fields, 3), 1, NAME_CAP)),
        },
        {name: blank_to_null(name) for name in PARSED},
    ]
    for step in steps:
        df = df.withColumns(step)
    return df.drop(*[name for step in steps for name in step if name.startswith("__")])


def ingest_logins(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Log rows of login events, stamped with the run time (or the time of processing).

    A mobile login with an unknown client string keeps that string in
    ``m_exception`` and has no parsed columns.
    """
    moment = F.localtimestamp() if as_of is None else at(as_of)
    rejected = is_mobile("login_tp") & ~valid_client("sso")
    rows = parse_client(df, "sso", "login_tp").withColumns(
        {
            "login_ip1": F.col("login_ip"),
            "login_dt": stamp14(moment),
            "m_exception": F.when(rejected, F.col("sso")),
        }
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LOGIN_LOG.fields])
