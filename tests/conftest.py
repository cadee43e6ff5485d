import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

from panelkit.runtime import ship_package
from panelkit.spec import PanelSpec


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("panelkit-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def regression(spark):
    """y = 2 f0 + 1.5 f1 + noise with five features; 100 train and 30 test rows."""
    rng = np.random.default_rng(42)
    names = [f"f{i}" for i in range(5)]
    pdf = pd.DataFrame(rng.normal(size=(130, 5)), columns=names)
    pdf["y"] = 2 * pdf["f0"] + 1.5 * pdf["f1"] + rng.normal(scale=0.2, size=130)
    pdf.insert(0, "entity", [f"e{i % 13:02d}" for i in range(130)])
    pdf.insert(1, "period", [2000 + i // 13 for i in range(130)])
    spec = PanelSpec(target="y", features=tuple(names), period_bounds=(1900, 2100))
    df = spark.createDataFrame(pdf)
    df = df.withColumn("period", df["period"].cast("int")).cache()
    train = df.where(df["period"] < 2008)
    test = df.where(df["period"] >= 2008)
    return train, test, spec, pdf


@pytest.fixture(scope="session")
def panel(spark):
    """20 entities x 20 years with an entity effect and persistent noise."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(20):
        effect, y = rng.normal(), 0.0
        for year in range(2000, 2020):
            gdp, trade = 40000 + 5000 * effect + rng.normal() * 2000, 50 + rng.normal() * 10
            y = 0.5 * y + 0.3 * effect + 0.00005 * (gdp - 40000) + 0.01 * trade + rng.normal() * 0.2
            rows.append((f"C{i:02d}", year, float(y), float(gdp), float(trade)))
    pdf = pd.DataFrame(rows, columns=["entity", "period", "y", "gdp", "trade"])
    spec = PanelSpec(target="y", features=("gdp", "trade"), period_bounds=(1900, 2100))
    df = spark.createDataFrame(rows, "entity string, period int, y double, gdp double, trade double")
    return df.cache(), spec, pdf
