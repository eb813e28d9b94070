from __future__ import annotations

import random
import re
import uuid
from datetime import datetime

import pytest

from tests.conftest import rows
from tidemark.plans.logins import ingest_logins, parse_client
from tidemark.schemas import LOGIN_EVENT, LOGIN_LOG
from tidemark.sources.staging import shared_folder
from tidemark.streaming.logins import ingest_logins_stream, read_login_stream

AS_OF = datetime(2024, 1, 10, 9, 0, 5)
N = None

# login type, string, route, app, platform, version, device, maker, number
GOLDEN = [
    ("M", "Bugs 1.0.2 (iPhone Simulator ver 3.1.2)", "ok", "1.0.2", "iOS", "3.1.2", "iPhone", "Apple", N),
    ("M", "Bugs 2.0 (Android 2.2, Galaxy S, Samsung, 356)", "ok", "2.0", "Android", "2.2", "Galaxy S", "Samsung", "356"),
    ("M", "Bugs 2.0 (android 2.2,,LG)", "ok", "2.0", "android", "2.2", N, "LG", N),
    ("M", "Bugs 2.0 (Android 2.2, A, B, C, D)", "ok", "2.0", "Android", "2.2", "A", "B", "C"),
    ("M", "Bugs 1.1 (Windows mobile 6.5)", "ok", "1.1", "Windows mobile", "6.5", N, N, N),
    ("M", "Bugs 1.1 (windows mobile 6.5)", "ok", "1.1", N, "6.5", N, N, N),
    ("M", "Bugs 3 (iPod touch 4.0)", "ok", "3", "iOS", "4.0", "iPod", "Apple", N),
    ("M", "Bugs 3 iPad 4.0)", "ok", N, "iOS", "4.0", "iPad", "Apple", N),
    ("M", "Bugs (iPhone x)", "ok", N, "iOS", N, "iPhone", "Apple", N),
    ("M", "Bugs iPhone 1.0 (none)", "ok", "iPhone 1.0", N, N, N, N, N),
    ("M", "Bugs\t1.0 (iPhone 3.1)", "ok", "Bugs\t1.0", N, N, N, N, N),
    ("M", "Bugs 1.0 (iPhone)", "exc", N, N, N, N, N, N),
    ("M", "Melon 1.0 (iPhone 3)", "exc", N, N, N, N, N, N),
    ("M", N, "exc", N, N, N, N, N, N),
    ("W", "Bugs 1.0.2 (iPhone 3)", "ok", N, N, N, N, N, N),
    (N, "Bugs 1.0.2 (iPhone 3)", "ok", N, N, N, N, N, N),
    # beyond the example strings
    ("M", "Bugs 1 (Android " + "9" * 30 + ", " + "d" * 60 + ")", "ok", "1", "Android", "9" * 20, "d" * 50, N, N),
    ("M", "Bugs 1 (Android x, a)b, c)", "ok", "1", "Android", "x", "ab", "c", N),
    ("M", "Bugs 5 (Android 1, iPhone )", "ok", "5", "Android", "1", "iPhone ", N, N),
    ("M", "Bugs x(iPhone 1.)", "ok", N, "iOS", "1.", "iPhone", "Apple", N),
    ("M", "Bugs abc (iphone 2)", "ok", "abc", "iOS", "2", "iphone", "Apple", N),
]
COLUMNS = ["m_app_ver", "m_platform_nm", "m_platform_ver", "m_device_nm", "m_comp_nm", "m_device_no"]


def events(spark):
    data = [(i, i * 2, f"10.0.0.{i}", g[0], "ref", g[1]) for i, g in enumerate(GOLDEN)]
    return spark.createDataFrame(data, LOGIN_EVENT)


def expected_log():
    out = []
    for i, (kind, sso, route, *parsed) in enumerate(GOLDEN):
        exception = sso if route == "exc" else None
        out.append((i, i * 2, f"10.0.0.{i}", kind, "20240110090005", "ref", *parsed, exception))
    return sorted(out, key=repr)


def test_log_rows(spark):
    log = ingest_logins(events(spark), AS_OF)
    assert log.schema.names == LOGIN_LOG.names
    assert rows(log) == expected_log()


def test_parse_alone_looks_at_the_string_only(spark):
    got = parse_client(events(spark)).select("msrl", *COLUMNS)
    assert (14, "1.0.2", "iOS", "3", "iPhone", "Apple", None) in rows(got)


def cut(text, start, length):
    """A substring where an empty result or a length below one is NULL."""
    if text is None or length is None or length < 1:
        return None
    return text[start - 1 : start - 1 + length] or None


def loop_model(kind, sso):
    """The parsed columns and the exception, one variable after the other."""
    out = dict.fromkeys(COLUMNS)
    if kind != "M":
        return out, None
    known = re.search(r"i[Pp]hone\s|i[Pp]od\s|i[Pp]ad\s|[Aa]ndroid\s|[Ww]indows mobile\s", sso or "")
    if not known or not re.match(r"Bugs\s", sso):
        return out, sso
    total = len(sso) if sso.startswith("Bugs ") else None
    body = (cut(sso, 6, total) if total else sso).replace(", ", ",")
    bracket = body.find("(") + 1
    out["m_app_ver"] = cut(body, 1, bracket - 2)
    rest = cut(body, bracket + 1, total)
    if rest is None:
        return out, None
    closed = re.search(r"[0-9.]+\)", rest)
    version = closed.group().replace(")", "") if closed else None
    apple = re.search("i[Pp]hone|i[Pp]od|i[Pp]ad", rest)
    android = re.search("[Aa]ndroid", rest)
    if android:
        out["m_platform_nm"] = android.group()
        for number, part in enumerate(rest.replace(")", "").split(","), 1):
            if number == 1:
                out["m_platform_ver"] = cut(re.sub("[Aa]ndroid ", "", part), 1, 20)
            elif number <= 4:
                out[{2: "m_device_nm", 3: "m_comp_nm", 4: "m_device_no"}[number]] = cut(part, 1, 50)
    elif re.search("[Ww]indows mobile", rest):
        out["m_platform_nm"] = "Windows mobile" if "Windows mobile" in rest else None
        out["m_platform_ver"] = version or None
    elif apple:
        out |= {"m_platform_nm": "iOS", "m_device_nm": apple.group(), "m_comp_nm": "Apple"}
        out["m_platform_ver"] = version or None
    return out, None


PIECES = [
    "Bugs ", "Bugs ", "Bugs\t", "bugs ", "(", "(", ")", ")", ", ", ",", ",,", " ", "1.0.2", "3", ".", "é한",
    "Android ", "android ", "Android", "iPhone ", "iphone", "iPod ", "ipad ", "Windows mobile ", "windows mobile ",
    "Windows", "x" * 60, "9" * 25,
]


def test_random_strings_against_a_loop(spark):
    rng = random.Random(7)
    data = []
    for i in range(6000):
        start = rng.choice(["Bugs ", "Bugs ", "Bugs ", ""])
        sso = start + "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 9)))
        data.append((i, i, None, rng.choice(["M", "M", "M", "W", None]), None, sso or None))
    df = spark.createDataFrame(data, LOGIN_EVENT).repartition(8)
    got = {r["msrl"]: r for r in ingest_logins(df, AS_OF).collect()}
    parsed = 0
    for i, _, _, kind, _, sso in data:
        columns, exception = loop_model(kind, sso)
        assert {c: got[i][c] for c in COLUMNS} == columns, sso
        assert got[i]["m_exception"] == exception, sso
        parsed += columns["m_platform_nm"] is not None
    assert parsed > 1000


def test_log_has_no_shuffle(spark):
    plan = ingest_logins(events(spark), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_stream_equals_batch_and_restarts(spark):
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    arrived = events(spark).cache()
    where = f"{folder}/log", f"{folder}/checkpoint", AS_OF

    arrived.where("msrl < 9").repartition(3).write.parquet(f"{folder}/events")
    for _ in range(2):  # a restart without new files adds nothing
        stream = read_login_stream(spark, f"{folder}/events", files_per_trigger=1)
        ingest_logins_stream(stream, *where).awaitTermination()
    arrived.where("msrl >= 9").write.mode("append").parquet(f"{folder}/events")
    ingest_logins_stream(read_login_stream(spark, f"{folder}/events"), *where).awaitTermination()

    assert rows(spark.read.schema(LOGIN_LOG).parquet(f"{folder}/log")) == expected_log()


def test_time_of_processing_without_a_run_time(spark):
    stamp = ingest_logins(events(spark)).first()["login_dt"]
    assert len(stamp) == 14 and abs(datetime.strptime(stamp, "%Y%m%d%H%M%S").year - datetime.now().year) <= 1


@pytest.mark.parametrize("name", COLUMNS)
def test_parsed_columns_are_never_blank(spark, name):
    assert ingest_logins(events(spark), AS_OF).where(f"{name} = ''").count() == 0
