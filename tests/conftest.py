import pytest

from cartlake.schemas import BRONZE_WITH_ID
from cartlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze(spark):
    """Builds a bronze table from short event tuples
    (time, type, product, category, brand, price, user, session)."""

    def build(events):
        rows = [
            (i, f"{time} UTC" if time else time, kind, product, 1, category, brand, price, user, session)
            for i, (time, kind, product, category, brand, price, user, session) in enumerate(events)
        ]
        return spark.createDataFrame(rows, BRONZE_WITH_ID)

    return build


def event(time, kind, session="s1", user=1, price=10.0, category="a.b", brand="x", product=1):
    return (time, kind, product, category, brand, price, user, session)


GOLDEN = [
    ("2019-10-01 05:01:02", "view", 1004776, "electronics.smartphone", "xiaomi", 185.08),
    ("2019-10-01 05:01:53", "view", 1004739, "electronics.smartphone", "xiaomi", 197.52),
    ("2019-10-01 05:02:29", "view", 1004133, "electronics.smartphone", "xiaomi", 135.99),
    ("2019-10-01 05:02:50", "cart", 1004739, "electronics.smartphone", "xiaomi", 197.52),
    ("2019-10-01 05:03:35", "view", 1004739, "electronics.smartphone", "xiaomi", 197.52),
]
GOLDEN_SESSION = "49d03116-3c95-4e13-8b9c-e3be97551fe8"


def golden_events():
    return [(*row, 386070015, GOLDEN_SESSION) for row in GOLDEN]


def by(df, key):
    return {row[key]: row for row in df.collect()}
