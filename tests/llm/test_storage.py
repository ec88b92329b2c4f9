"""Tables and shuffles that finished steps leave behind."""

import time

from estatelens.llm.storage import drop_shuffles, written


def test_shuffles_of_finished_steps_are_deleted(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return sum(b.name().startswith("shuffle_") for b in spark._jvm.scala.jdk.javaapi
                   .CollectionConverters.asJava(manager.getAllBlocks()))

    drop_shuffles(spark)
    time.sleep(2)
    before = shuffles()
    written(spark.range(1000).repartition(3, "id"), "dealt")
    assert shuffles() > before
    drop_shuffles(spark)
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.2)
    assert shuffles() <= before
