"""Parquet files of different layouts as one table.

Every file's footer tells its layout: tasks read the footers, files of one layout are
read together, and the layouts are joined column by column to the smallest type
that holds them all. Columns a layout does not have are null.
"""

from collections.abc import Iterator
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole numbers by range, with the digits that a decimal needs to hold them.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_FRACTIONS = (T.FloatType, T.DoubleType)
_MAX_DIGITS = 38


def supertype(a: T.DataType, b: T.DataType) -> T.DataType:
    """The smallest type that holds both.

    Whole numbers widen; with a fraction they become double, with a decimal a decimal
    that has room for both. A date becomes a timestamp, and anything that has a text
    form becomes text beside text. Structs are joined field by field, arrays and maps
    by their elements. Types without a common one are an error.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return a if _WHOLE[type(a)] >= _WHOLE[type(b)] else b
    numbers = (*_WHOLE, *_FRACTIONS, T.DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, _FRACTIONS) or isinstance(b, _FRACTIONS):
            return T.DoubleType()
        return _decimal(a, b)
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        zoned = isinstance(a, T.TimestampType) or isinstance(b, T.TimestampType)
        return T.TimestampType() if zoned else T.TimestampNTZType()
    texts = (*numbers, *times, T.BooleanType, T.StringType)
    if isinstance(a, T.StringType) and isinstance(b, texts) or isinstance(b, T.StringType) and isinstance(a, texts):
        return T.StringType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return join_layouts(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(supertype(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(supertype(a.keyType, b.keyType), supertype(a.valueType, b.valueType))
    raise ValueError(f"no common type of {a.simpleString()} and {b.simpleString()}")


def _decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    sides = [x if isinstance(x, T.DecimalType) else T.DecimalType(_WHOLE[type(x)], 0) for x in (a, b)]
    scale = max(s.scale for s in sides)
    digits = max(s.precision - s.scale for s in sides) + scale
    return T.DecimalType(digits, scale) if digits <= _MAX_DIGITS else T.DoubleType()


def join_layouts(*layouts: T.StructType) -> T.StructType:
    """All columns of all layouts, each with the type that holds it in every layout.

    Columns stand in the order in which they first appear, and all may be null.
    """
    kinds: dict[str, T.DataType] = {}
    for layout in layouts:
        for field in layout.fields:
            before = kinds.get(field.name, T.NullType())
            try:
                kinds[field.name] = supertype(before, field.dataType)
            except ValueError as clash:
                raise ValueError(f"column {field.name}: {clash}") from None
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def to_layout(df: DataFrame, layout: T.StructType) -> DataFrame:
    """A frame in a layout that joins its own: columns widened, absent ones null."""
    own = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_widened(F.col(f"`{f.name}`") if f.name in own else None, own.get(f.name), f.dataType).alias(f.name) for f in layout])


def _widened(value: Column | None, kind: T.DataType | None, target: T.DataType) -> Column:
    if value is None or kind is None:
        return F.lit(None).cast(target)
    if isinstance(target, T.StructType) and isinstance(kind, T.StructType):
        own = {f.name: f.dataType for f in kind.fields}
        fields = [_widened(value[f.name] if f.name in own else None, own.get(f.name), f.dataType).alias(f.name) for f in target]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType) and isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _widened(x, kind.elementType, target.elementType))
    if isinstance(target, T.MapType) and isinstance(kind, T.MapType):
        keys = F.transform(F.map_keys(value), lambda x: _widened(x, kind.keyType, target.keyType))
        values = F.transform(F.map_values(value), lambda x: _widened(x, kind.valueType, target.valueType))
        return F.map_from_arrays(keys, values)
    return value.cast(target)


def read_layouts(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """The Parquet files below a folder by layout; a folder that is not there has none.

    Footers are opened by tasks, none on the driver; only paths and the text of each
    layout come back. A file whose storage tasks cannot open by themselves has the
    layout '' and is left to Spark's own merging of schemas.
    """

    def layouts(batches: Iterator) -> Iterator:
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def layout(path: str) -> str:
            scheme, _, rest = path.partition(":")
            try:
                if scheme == "file":
                    system, place = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    system, place = fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
                with system.open_input_file(place) as file:
                    schema = pq.ParquetFile(file).schema
                    columns = [schema.column(k) for k in range(len(schema))]
                    return "; ".join(
                        f"{c.path} {c.physical_type} {c.logical_type} {c.max_definition_level} {c.max_repetition_level}"
                        for c in columns
                    )
            except (OSError, ValueError, NotImplementedError):
                return ""

        for batch in batches:
            paths = batch.column("path")
            found = pa.array([layout(p) for p in paths.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([paths, found], ["path", "layout"])

    try:
        # The content column is not selected, so no file is read here, only listed.
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true")
            .load(folder)
            .select("path")
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    found: dict[str, list[str]] = {}
    for row in files.mapInArrow(layouts, "path string, layout string").sort("path").collect():
        found.setdefault(row.layout, []).append(row.path)
    return found


def read_mixed(spark: SparkSession, *folders: str) -> DataFrame | None:
    """All rows of all Parquet files below the folders, in the joined layout; None without files.

    Folders named ``column=value`` add that column.
    """
    frames = []
    for folder in folders:
        for layout, paths in read_layouts(spark, folder).items():
            reader = spark.read.option("basePath", folder)
            frames.append(reader.option("mergeSchema", "false" if layout else "true").parquet(*paths))
    if not frames:
        return None
    joined = join_layouts(*[f.schema for f in frames])
    return reduce(DataFrame.unionByName, [to_layout(f, joined) for f in frames])
