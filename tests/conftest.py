from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Raw customer table in the shape of the churn specification.
CUSTOMER_COLUMNS = (
    "customerID string, gender string, SeniorCitizen int, Partner string, Dependents string, tenure int, "
    "PhoneService string, MultipleLines string, InternetService string, OnlineSecurity string, "
    "OnlineBackup string, DeviceProtection string, TechSupport string, StreamingTV string, "
    "StreamingMovies string, Contract string, PaperlessBilling string, PaymentMethod string, "
    "MonthlyCharges double, TotalCharges string, Churn string"
)

YES_NO = ("No", "Yes")
LINES = ("No", "Yes", "No phone service")
WEB = ("No", "Yes", "No internet service")


def customer_rows(n: int) -> list[tuple]:
    rows = []
    for i in range(n):
        tenure = (i * 7) % 73
        monthly = 20.0 + (i * 37 % 1000) / 10.0
        web = [WEB[(i // (j + 1)) % 3] for j in range(6)]
        rows.append((
            f"C{i:05d}", ("Female", "Male")[i % 2], int(i % 6 == 0), YES_NO[i // 2 % 2], YES_NO[i // 3 % 2], tenure,
            YES_NO[i % 5 != 0], LINES[i % 3], ("DSL", "Fiber optic", "No")[i // 4 % 3], *web,
            ("Month-to-month", "One year", "Two year")[i // 5 % 3], YES_NO[i // 7 % 2],
            ("Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)")[i % 4],
            monthly, " " if tenure == 0 else str(round(monthly * tenure, 2)),
            YES_NO[int(tenure < 20 and i % 3 != 0)],
        ))
    return rows


@pytest.fixture(scope="session")
def customers(spark):
    return spark.createDataFrame(customer_rows(600), CUSTOMER_COLUMNS).cache()
