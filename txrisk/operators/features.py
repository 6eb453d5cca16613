"""Model inputs: projection, median imputation, standardization."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.operators.quantiles import SMALL_GROUP, column_quantiles, column_statistics


def project_features(df: DataFrame, features=tuple(S.FEATURES)) -> DataFrame:
    """Only the model inputs, as doubles."""
    S.check_columns(df, features)
    return df.select(*[F.col(c).cast("double").alias(c) for c in features])


def feature_medians(df: DataFrame, features=tuple(S.FEATURES), *, rows=None, small=SMALL_GROUP):
    """Median of each feature over the table, missing values skipped."""
    return column_quantiles(project_features(df, features), features, 0.5, rows=rows, small=small)


def fill_features(df: DataFrame, medians: dict) -> DataFrame:
    """Fill missing features with given medians; a feature without a median stays null."""
    fills = {
        c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items() if m is not None
    }
    return df.withColumns(fills)


def impute_median(df: DataFrame, features=tuple(S.FEATURES), *, rows=None, small=SMALL_GROUP):
    """Feature columns with missing values filled by each feature's own median."""
    table = project_features(df, features)
    return fill_features(table, feature_medians(df, features, rows=rows, small=small))


def feature_moments(df: DataFrame, features=tuple(S.FEATURES)) -> dict:
    """(mean, population standard deviation) of each feature, from one aggregation."""
    row = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in features],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in features],
    ).first()
    return {c: (row[f"mean_{c}"], row[f"std_{c}"]) for c in features}


def feature_statistics(
    df: DataFrame, features=tuple(S.FEATURES), *, rows=None, small=SMALL_GROUP
) -> tuple[dict, dict]:
    """Medians, and the moments after filling missing values with them.

    The moments come from the scan that the medians need anyway: a filled column is the
    known values and a constant.
    """
    table = project_features(df, features)
    sums = {"_rows": F.count(F.lit(1))}
    for c in features:
        sums |= {f"_n_{c}_known": F.count(c), f"_mean_{c}": F.avg(c), f"_std_{c}": F.stddev_pop(c)}
    medians, got = column_statistics(table, features, 0.5, sums, rows=rows, small=small)
    moments = {}
    for c in features:
        n, mean, std = (got[k] for k in (f"_n_{c}_known", f"_mean_{c}", f"_std_{c}"))
        moments[c] = (mean, std)
        filled = got["_rows"] - n
        if n and filled:
            rows_all, fill = got["_rows"], medians[c]
            both = (n * mean + filled * fill) / rows_all
            spread = n * (std**2 + (mean - both) ** 2) + filled * (fill - both) ** 2
            moments[c] = (both, (spread / rows_all) ** 0.5)
    return medians, moments


def scale_features(df: DataFrame, moments: dict) -> DataFrame:
    """(x - mean) / std; a constant feature is only centred."""
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)
            for c, (m, s) in moments.items()
            if m is not None
        }
    )


def standardize(df: DataFrame, features=tuple(S.FEATURES)) -> DataFrame:
    return scale_features(df, feature_moments(df, features))
