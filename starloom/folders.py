"""Files and folders of any store that Spark reaches, named by their paths."""


def _at(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark, path):
    store, target = _at(spark, path)
    return store.exists(target)


def names(spark, path):
    """What a folder holds, by name; nothing for a folder that isn't there."""
    store, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(target)) if store.exists(target) else []


def qualified(spark, path):
    """The path with the store that Spark takes it to be in."""
    store, target = _at(spark, path)
    return store.makeQualified(target).toString()


def make(spark, path):
    store, target = _at(spark, path)
    return store.mkdirs(target)


def drop(spark, path):
    store, target = _at(spark, path)
    return store.delete(target, True)


def moved_in(spark, path, other):
    """Moves `path` to `other`, which must not be there yet; False if it is or the store refuses."""
    store, target = _at(spark, path)
    place = spark._jvm.org.apache.hadoop.fs.Path(other)
    return not store.exists(place) and store.rename(target, place)
