"""Stages of the pipeline begin with executors whose garbage is collected."""

import corpus_pipeline as cp


def collections(spark):
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return {b.getName(): b.getCollectionCount() for b in beans}


def test_a_stage_collects_garbage_in_tasks(spark):
    @cp.stage
    def nothing(spark, docs, sf_dir):
        return docs

    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    sc, before = spark.sparkContext, collections(spark)
    sc.setJobGroup("nothing-stage", "a stage without work of its own")
    try:
        nothing(spark, docs, "")
        told = sc.statusTracker()
        stages = [s for j in told.getJobIdsForGroup("nothing-stage") for s in told.getJobInfo(j).stageIds]
        assert [told.getStageInfo(s).numTasks for s in stages] == [sc.defaultParallelism]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    after = collections(spark)
    # the driver's own collection is one; the tasks ask for more
    assert sum(after.values()) >= sum(before.values()) + 2
