"""Small inputs built by rule (no copied data)."""

from __future__ import annotations

# The three iris species, 50 rows each, in this order.
SPECIES = ("Iris-setosa", "Iris-versicolor", "Iris-virginica")
IRIS_SCHEMA = ("sepal_length double, sepal_width double, petal_length double, "
               "petal_width double, species string")


def iris_like_rows():
    """150 rows shaped like iris: 50 per species, sorted by species.

    Petal sizes separate the species (as in the real data), so a tree learns them.
    """
    rows = []
    for s, name in enumerate(SPECIES):
        for i in range(50):
            wiggle = (i * 37 % 50) / 50.0
            rows.append((4.5 + s * 0.8 + wiggle, 3.4 - s * 0.3 + wiggle / 2,
                         1.2 + s * 2.2 + wiggle, 0.2 + s * 0.9 + wiggle / 3, name))
    return rows


def iris_csv_text():
    """The same rows as the studied iris CSV layout: Id first, CamelCase header."""
    head = "Id,SepalLengthCm,SepalWidthCm,PetalLengthCm,PetalWidthCm,Species"
    body = [f"{i + 1},{a:.1f},{b:.1f},{c:.1f},{d:.1f},{e}"
            for i, (a, b, c, d, e) in enumerate(iris_like_rows())]
    return "\n".join([head] + body) + "\n"


# Column names of the bank marketing CSV (fixture D5).
BANK_NUMERIC_RAW = ("age", "duration", "campaign", "pdays", "previous", "emp.var.rate",
                    "cons.price.idx", "cons.conf.idx", "euribor3m", "nr.employed")
BANK_CATEGORICAL = ("job", "marital", "education", "default", "housing", "loan", "contact",
                    "month", "day_of_week", "poutcome")
JOBS = ("admin.", "blue-collar", "technician", "services", "management", "retired")
MONTHS = ("may", "jun", "jul", "aug", "nov")
DAYS = ("mon", "tue", "wed", "thu", "fri")


def bank_csv_text(n: int = 200, *, singleton_level: bool = True,
                  constant_column: bool = True, labels=("no", "yes")) -> str:
    """``;``-separated bank-like CSV with a header; ``y`` follows ``duration``."""
    header = ";".join(BANK_NUMERIC_RAW[:5] + ("job", "marital", "education", "default",
                                              "housing", "loan", "contact", "month",
                                              "day_of_week", "poutcome")
                      + BANK_NUMERIC_RAW[5:] + ("y",))
    lines = [header]
    for i in range(n):
        duration = (i * 53) % 600
        label = labels[min(len(labels) - 1, duration * len(labels) // 600)]
        job = "student" if (singleton_level and i == n - 1) else JOBS[i % len(JOBS)]
        nums1 = [20 + i % 50, duration, 1 + i % 4, 999, i % 3]
        cats = [job, ("married", "single")[i % 2], ("basic", "university")[i % 2 ^ 1],
                "no", ("yes", "no")[i % 3 == 0], "no", ("cellular", "telephone")[i % 2],
                MONTHS[i % len(MONTHS)], DAYS[i % len(DAYS)], "nonexistent"]
        nums2 = [1.1 if constant_column else (i % 5) * 0.5, 93.2 + (i % 7) * 0.1,
                 -36.4 + (i % 3), 4.8 + (i % 11) * 0.01, 5191.0]
        lines.append(";".join(str(v) for v in nums1 + cats + nums2 + [label]))
    return "\n".join(lines) + "\n"
