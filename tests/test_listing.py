from __future__ import annotations


def test_named_files_are_not_listed_by_a_task_each(spark, tmp_path):
    """As in each batch of the landing stream."""
    paths = [str(tmp_path / f"{i}.txt") for i in range(60)]
    for path in paths:
        with open(path, "w") as file:
            file.write("x")
    spark.sparkContext.setJobGroup("listing", "listing")
    assert len(spark.read.text(paths).inputFiles()) == 60
    tracker = spark.sparkContext.statusTracker()
    tasks = [
        tracker.getStageInfo(stage).numTasks
        for job in tracker.getJobIdsForGroup("listing")
        for stage in tracker.getJobInfo(job).stageIds
        if tracker.getStageInfo(stage)
    ]
    spark.sparkContext._jsc.clearJobGroup()
    assert 0 < max(tasks) <= 32
