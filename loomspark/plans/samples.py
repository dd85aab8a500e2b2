"""Tables the queries derive from the given ones: source code, records and metadata, the same in both dialects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCES = ("stack_v2_python", "codesearchnet_python", "debugbench", "fineweb_edu", "cosmopedia_cs", "synthetic")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row of source text for each part: id, source, path, docstring, text; eight kinds of text in turn.

    A few MB of parts, one split, become a GB of texts: the parts are dealt to all tasks before.
    """
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice").repartition("p_partkey")
    body = F.concat(F.lit("def f_"), F.col("p_partkey"), F.lit('(x):\n    """'), F.col("p_name"), F.lit(" "), F.col("p_type"), F.lit('"""\n    if x is None:\n        raise ValueError("empty")\n    return x + '), F.col("p_size"), F.lit("\n"))
    k = F.col("p_partkey") % 8
    text = (
        F.when(k == 0, F.concat(F.repeat(F.lit("# header line\n"), 45), body))
        .when(k == 1, F.concat(F.repeat(F.lit("pkg==1.0\n"), 25), F.col("p_name")))
        .when(k == 2, F.concat(F.lit("Traceback (most recent call last):\nValueError: "), F.col("p_name"), F.lit("\n\nbuggy_code:\n"), body))
        .when(k == 3, F.concat(F.lit("def broken(:\n    "), F.col("p_name"), F.lit("\n")))
        .when(k == 4, F.concat(F.lit("import os\nos.system('rm -rf /')\n# "), F.col("p_name"), F.lit("\n")))
        .when(k == 5, F.concat(F.lit("A python algorithm with recursion and good complexity for "), F.col("p_name"), F.lit(".\n")))
        .when(k == 6, F.concat(F.lit("A page about "), F.col("p_name"), F.lit(" and its price.\n")))
        .otherwise(F.concat(body, F.lit("\n\nclass C:\n    def g(self):\n        return self.x\n\nassert f_(1)\n")))
    )
    source = F.element_at(F.array(*map(F.lit, SOURCES)), (F.floor(F.col("p_partkey") / 8) % 6 + 1).cast("int"))
    path = F.when(F.col("p_partkey") % 10 == 0, F.lit("lib\\deep\\poetry.lock")).otherwise(F.concat(F.lit("src/"), F.col("p_name"), F.lit(".py")))
    return p.select(F.col("p_partkey").alias("id"), source.alias("source"), path.alias("path"), F.col("p_name").alias("docstring"), text.alias("text"), "p_size", "p_retailprice")


_BODY = """concat('def f_', p_partkey, '(x):', chr(10), '    \"\"\"', p_name, ' ', p_type, '\"\"\"', chr(10), '    if x is None:', chr(10), '        raise ValueError("empty")', chr(10), '    return x + ', p_size, chr(10))"""
CODE_SQL = f"""code AS (SELECT p_partkey AS id, ['{"', '".join(SOURCES)}'][(p_partkey // 8) % 6 + 1] AS source,
  CASE WHEN p_partkey % 10 = 0 THEN 'lib\\deep\\poetry.lock' ELSE concat('src/', p_name, '.py') END AS path, p_name AS docstring,
  CASE p_partkey % 8 WHEN 0 THEN concat(repeat('# header line' || chr(10), 45), {_BODY})
    WHEN 1 THEN concat(repeat('pkg==1.0' || chr(10), 25), p_name)
    WHEN 2 THEN concat('Traceback (most recent call last):', chr(10), 'ValueError: ', p_name, chr(10), chr(10), 'buggy_code:', chr(10), {_BODY})
    WHEN 3 THEN concat('def broken(:', chr(10), '    ', p_name, chr(10))
    WHEN 4 THEN concat('import os', chr(10), 'os.system(''rm -rf /'')', chr(10), '# ', p_name, chr(10))
    WHEN 5 THEN concat('A python algorithm with recursion and good complexity for ', p_name, '.', chr(10))
    WHEN 6 THEN concat('A page about ', p_name, ' and its price.', chr(10))
    ELSE concat({_BODY}, chr(10), chr(10), 'class C:', chr(10), '    def g(self):', chr(10), '        return self.x', chr(10), chr(10), 'assert f_(1)', chr(10)) END AS text, p_size, p_retailprice FROM part)"""
