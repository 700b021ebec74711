"""Column builders shared by the operators."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Several short tasks per core even out what single ones take.
TASKS_PER_CORE = 3


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with a border that filters and projections do not cross.

    Catalyst moves a filter below the projection it refers to by repeating the
    projected expressions inside the filter. For the parse and check chain that
    would run every expression again, nested many times over. A one-element
    ``inline`` yields each row unchanged and keeps the filter above.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def spread(df: DataFrame) -> DataFrame:
    """The same rows dealt evenly over all cores, equal ones too.

    A file is read by one task per row group at most. Where the work on a row costs far more
    than its reading, few row groups would leave most cores idle however many there are.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks)
