"""AttentionSteps.java, compiled once a session and carried out where the rows are, in Spark's own tasks."""

from __future__ import annotations

import logging
import os
import subprocess
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SOURCE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "AttentionSteps.java")
# By application: what loads the classes, or None where they cannot be had; the folders of the jars.
_LOADERS: dict[str, object] = {}
_FOLDERS: list[tempfile.TemporaryDirectory] = []


def _compiled(jvm, to: str) -> str:
    """A jar of the classes, made with the compiler beside the driver's Java."""
    of = jvm.java.lang.System.getProperty
    classes = os.path.join(to, "classes")
    javac = os.path.join(of("java.home"), "bin", "javac")
    command = [javac, "-J-Xmx256m", "-nowarn", "--add-modules", "jdk.incubator.vector", "-cp", of("java.class.path"), "-d", classes, _SOURCE]
    ran = subprocess.run(command, capture_output=True, text=True, timeout=120)
    if ran.returncode:
        raise OSError(ran.stderr[-500:])
    jar = os.path.join(to, "attention-steps.jar")
    with zipfile.ZipFile(jar, "w") as out:
        for folder, _, names in os.walk(classes):
            for name in sorted(names):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, classes))
    return jar


def _made(spark: SparkSession, loader, name: str, given):
    """An object of the nested class `name`."""
    args = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.Object, len(given))
    for i, x in enumerate(given):
        if isinstance(x, list):
            x, parts = spark._jvm.java.util.ArrayList(), x
            for part in parts:
                x.add(part)
        args[i] = x
    return loader.loadClass(f"carryall.AttentionSteps${name}").getConstructors()[0].newInstance(args)


def _loader(spark: SparkSession, sizes: str):
    jvm = spark._jvm
    folder = tempfile.TemporaryDirectory(prefix="carryall-")
    _FOLDERS.append(folder)
    jar = _compiled(jvm, os.path.realpath(folder.name))
    urls = spark.sparkContext._gateway.new_array(jvm.java.net.URL, 1)
    urls[0] = jvm.java.io.File(jar).toURI().toURL()
    loader = jvm.java.net.URLClassLoader(urls, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    said = loader.loadClass("carryall.AttentionSteps").getMethod("sizes", None).invoke(None, None)
    if said != sizes:
        raise ValueError(f"made for {said}, not for {sizes}")
    spark.sparkContext._jsc.addJar(jar)
    return loader


def steps(spark: SparkSession, sizes: str):
    """What loads the classes of the steps; None without a Java compiler, or where `sizes` is not what they are made for."""
    key = spark.sparkContext.applicationId
    if key not in _LOADERS:
        try:
            _LOADERS[key] = _loader(spark, sizes)
        except Exception as why:  # of many kinds: no compiler, no module, no access to the JVM
            logging.getLogger(__name__).warning("steps in NumPy, which take longer: %s", str(why)[-500:])
            _LOADERS[key] = None
    return _LOADERS[key]


def mapped(df: DataFrame, loader, name: str, schema: str, *given) -> DataFrame:
    """Rows of `schema` that an object of the class `name` makes of each partition."""
    spark = df.sparkSession
    kind = spark._jvm.org.apache.spark.sql.Encoders.row(spark._jvm.org.apache.spark.sql.types.StructType.fromDDL(schema))
    return DataFrame(df._jdf.mapPartitions(_made(spark, loader, name, given), kind), spark)
