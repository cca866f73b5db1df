"""Splitting, encoding and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.missing import fill_mode, modes
from tabloom.plans.blocks import running_total
from tabloom.plans.quantiles import kth_smallest
from tabloom.plans.sizing import attach
from tabloom.plans.written import written


def hash_number(key: Column, seed: int) -> Column:
    """A number below 2^52, exact as a double, that depends on key and seed only."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def stratified_split(
    df: DataFrame, label: str, key: str, test: float = 0.25, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test), the test part holding the same share of every class.

    A row's side depends on its key and the seed, never on partitioning: per
    class, the round(test · n) smallest hashes are the test rows.
    """
    hashed = df.withColumn("_h", hash_number(F.col(key), seed))
    cut = kth_smallest(hashed, "_h", test, [label]).select(label, F.col("kth").alias("_cut"))
    side = attach(hashed.filter(F.col(label).isNotNull()), cut, [label]).withColumn(
        "_test", F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False))
    )
    clean = side.drop("_h", "_cut")
    return clean.filter(~F.col("_test")).drop("_test"), clean.filter("_test").drop("_test")


#: Up to so many levels, a category's levels are written into the plan as literals; more are joined.
LITERAL_LEVELS = 1000


def numbered_levels(df: DataFrame, col: str, out: str = "_id") -> DataFrame:
    """A row per distinct value with its place in sorted order, from 0.

    The places are running counts over order blocks, so no task and no driver sees all levels.
    """
    every = df.select(col).dropna().distinct()
    places = running_total(every, F.col(col), F.col(col), {out: F.lit(1)})
    return places.select(col, (F.col(out) - 1).cast("int").alias(out))


class Levels(Sequence):
    """Sorted distinct values of a column as a table (the column, ``_id``), read as a list only where a list is asked for."""

    def __init__(self, table: DataFrame, col: str):
        self.table, self.col, self._list = table, col, None

    def _read(self) -> list:
        if self._list is None:
            self._list = [r[0] for r in self.table.orderBy("_id").select(self.col).collect()]
        return self._list

    def __len__(self) -> int:
        return len(self._list) if self._list is not None else self.table.count()

    def __getitem__(self, at):
        return self._read()[at]

    def __iter__(self):
        return iter(self._read())

    def __eq__(self, other) -> bool:
        return self._read() == list(other)

    __hash__ = None


def levels(df: DataFrame, col: str) -> list:
    """Sorted distinct values of a category column, where columns or slots are named after them."""
    return [r[0] for r in df.select(col).dropna().distinct().orderBy(col).collect()]


def encode_labels(df: DataFrame, col: str, out: str = "label") -> tuple[DataFrame, Levels]:
    """Labels to ids in sorted order, with the levels that decode them; ids are numbered on Spark and joined, whatever the number of labels."""
    table = written(numbered_levels(df, col), "levels")
    return attach(df, table, [col]).select(*[c for c in df.columns if c != out], F.col("_id").alias(out)), Levels(table, col)


def decode_labels(df: DataFrame, col: str, names: Sequence, out: str) -> DataFrame:
    """Ids back to labels: by join where ``names`` is a table of levels, else from the list."""
    if isinstance(names, Levels):
        table = names.table.select(F.col("_id").alias(col), F.col(names.col).alias("_decoded"))
        return attach(df, table, [col]).select(*[c for c in df.columns if c != out], F.col("_decoded").alias(out))
    return df.withColumn(out, F.get(F.array(*[F.lit(n) for n in names]), F.col(col).cast("int")))


def _index(c: Column, names: Sequence) -> Column:
    position = F.array_position(F.array(*[F.lit(n) for n in names]), c)
    return F.when(position > 0, (position - 1).cast("int"))


def one_hot(df: DataFrame, cols: Sequence[str], drop_first: bool = True) -> DataFrame:
    """0/1 columns per level, nulls taken as the most frequent level; the first level dropped.

    A column per level suits few levels; ``one_hot_vector`` takes any number.
    """
    for c in cols:
        names = levels(df, c)
        filled = fill_mode(df.withColumn(f"_{c}", F.col(c)), [f"_{c}"])
        df = filled.withColumns(
            {f"{c}_{v}": (F.col(f"_{c}") == v).cast("int") for v in names[1 if drop_first else 0:]}
        ).drop(f"_{c}")
    return df


def one_hot_vector(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """One sparse vector of all columns' 0/1 slots, in the order of ``one_hot``; for any number of levels."""
    return CategoryEncoder(cols, out=out, literal=0).fit(df).transform(df)


def ordinal(df: DataFrame, col: str, order: Sequence, out: str) -> DataFrame:
    """Place in the given order; unknown and null take the most frequent known value's place."""
    known = df.withColumn("_known", F.when(F.col(col).isin(*order), F.col(col)))
    return fill_mode(known, ["_known"]).withColumn(out, _index(F.col("_known"), order)).drop("_known")


def scale(df: DataFrame, cols: Sequence[str], how: str = "standard") -> DataFrame:
    """Columns scaled in place: standard (deviation over n), minmax, or none."""
    if how == "none":
        return df
    aggs = {"standard": (F.avg, F.stddev_pop), "minmax": (F.min, F.max)}[how]
    stats = df.agg(*[f(c).cast("double").alias(f"_{i}_{c}") for c in cols for i, f in enumerate(aggs)])

    def scaled(c: str) -> Column:
        a, b = F.col(f"_0_{c}"), F.col(f"_1_{c}")
        width = b if how == "standard" else b - a
        # a constant column has no width and becomes 0
        return (F.col(c) - a) / F.when(width == 0, F.lit(1.0)).otherwise(width)

    return attach(df, stats).withColumns({c: scaled(c) for c in cols}).drop(*[f"_{i}_{c}" for c in cols for i in (0, 1)])


class CategoryEncoder(Estimator):
    """Learns modes and levels of category columns; writes one vector column.

    Plain columns become 0/1 slots without the first level; columns with a given
    order become one slot with the place. Nulls and values that were not seen
    are handled as in ``one_hot`` (all slots 0) and ``ordinal`` (the mode). A column
    with more than ``literal`` levels is encoded by a join with the table of its levels, into sparse slots.
    """

    def __init__(self, cat: Sequence[str], order: Mapping[str, Sequence] | None = None, out: str = "_encoded", literal: int = LITERAL_LEVELS):
        super().__init__()
        self.cat, self.order, self.out, self.literal = list(cat), {k: list(v) for k, v in (order or {}).items()}, out, literal

    def _levels(self, known: DataFrame, col: str) -> list | Levels:
        few = [r[0] for r in known.select(col).dropna().distinct().limit(self.literal + 1).collect()]
        return sorted(few) if len(few) <= self.literal else Levels(written(numbered_levels(known, col), "levels"), col)

    def _fit(self, dataset: DataFrame) -> CategoryEncoderModel:
        known = dataset.select(
            *self.cat, *[F.when(F.col(c).isin(*o), F.col(c)).alias(c) for c, o in self.order.items()]
        )
        mode = modes(known, known.columns).first().asDict() if known.columns else {}
        return CategoryEncoderModel({c: self._levels(known, c) for c in self.cat}, self.order, mode, self.out)


class CategoryEncoderModel(Model):
    def __init__(self, names: Mapping[str, list | Levels], order: Mapping[str, list], mode: Mapping[str, object], out: str):
        super().__init__()
        self.names, self.order, self.mode, self.out = names, order, mode, out

    def slots(self) -> list[str]:
        return [f"{c}_{v}" for c, names in self.names.items() for v in names[1:]] + list(self.order)

    def _cells(self, col: str) -> list[Column]:
        return [F.coalesce(F.col(col), F.lit(self.mode[col])).eqNullSafe(v).cast("double") for v in self.names[col][1:]]

    def _places(self) -> list[Column]:
        cells = []
        for c, order in self.order.items():
            # without any known value to take a mode from, every row gets the first place
            usual = order.index(self.mode[c]) if self.mode[c] is not None else 0
            cells.append(F.coalesce(_index(F.col(c), order), F.lit(usual)).cast("double"))
        return cells

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if not any(isinstance(names, Levels) for names in self.names.values()):
            cells = [cell for c in self.names for cell in self._cells(c)] + self._places()
            return dataset.withColumn(self.out, array_to_vector(F.array(*cells).cast("array<double>")))
        out, parts = dataset, []
        for i, (c, names) in enumerate(self.names.items()):
            part = f"_slots{i}"
            if isinstance(names, Levels):
                out = _sparse_slots(out, c, names, self.mode[c], part)
            else:
                out = out.withColumn(part, array_to_vector(F.array(*self._cells(c)).cast("array<double>")))
            parts.append(part)
        if self.order:
            out = out.withColumn("_slots_order", array_to_vector(F.array(*self._places())))
            parts.append("_slots_order")
        return VectorAssembler(inputCols=parts, outputCol=self.out).transform(out).drop(*parts)


def _sparse_slots(df: DataFrame, col: str, names: Levels, mode, out: str) -> DataFrame:
    """A sparse vector with a slot for every level but the first; all 0 for the first and for values not seen."""
    spark, n = df.sparkSession, len(names)
    if n < 2:
        return df.withColumn(out, array_to_vector(F.array().cast("array<double>")))
    filled = df.withColumn("_level", F.coalesce(F.col(col), F.lit(mode)))
    found = attach(filled, names.table.select(F.col(col).alias("_level"), "_id"), ["_level"])
    # the encoder leaves out the place behind the last, which stands for the first level and for unknown ones
    found = found.withColumn("_place", F.when(F.col("_id") > 0, F.col("_id") - 1).otherwise(n - 1).cast("double"))
    encoder = OneHotEncoder(inputCol="_place", outputCol=out, handleInvalid="keep")
    fitted = encoder.fit(spark.createDataFrame([(float(n - 2),)], "_place double"))
    return fitted.transform(found).drop("_level", "_id", "_place")


def number_stages(num: Sequence[str], how: str, out: str = "_scaled") -> list:
    """Stages that gather and scale number columns; nulls count as 0."""
    filled = ", ".join(f"coalesce(cast(`{c}` as double), 0d) as `_num_{c}`" for c in num)
    stages = [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"_num_{c}" for c in num], outputCol=out if how == "none" else "_raw"),
    ]
    if how == "standard":
        stages.append(StandardScaler(withMean=True, withStd=True, inputCol="_raw", outputCol=out))
    elif how == "minmax":
        stages.append(MinMaxScaler(inputCol="_raw", outputCol=out))
    return stages


def build_pipeline(
    cat: Sequence[str], order: Mapping[str, Sequence], num: Sequence[str], model, how: str = "standard"
) -> Pipeline:
    """Column transformer and classifier as one estimator, so that a search refits both per fold."""
    stages, parts = [], []
    if cat or order:
        stages.append(CategoryEncoder(cat, order))
        parts.append("_encoded")
    if num:
        stages += number_stages(num, how)
        parts.append("_scaled")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages + ([model] if model is not None else []))


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Spread a vector column over named number columns."""
    arr = vector_to_array(F.col(vector))
    return df.withColumns({n: arr[i] for i, n in enumerate(names)})
