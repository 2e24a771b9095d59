import threading

from tidemark import staging


def test_what_one_thread_releases_another_keeps(spark):
    began, told, kept = threading.Event(), threading.Event(), {}

    def other():
        mark = staging.mark()
        kept["df"] = staging.stage(spark.range(5), "other")
        began.set()
        assert told.wait(60)
        kept["n"] = kept["df"].count()
        staging.release(spark, mark)

    thread, mark = threading.Thread(target=other), staging.mark()
    thread.start()
    assert began.wait(60)
    mine, last = staging.stage(spark.range(3), "mine"), staging.stage(spark.range(7), "last")
    staging.release(spark, mark, last)
    told.set()
    thread.join(60)
    assert kept["n"] == 5 and last.count() == 7 and staging.mark() == mark + 1
    assert not [f for df in (mine, kept["df"]) for f in df.inputFiles() if spark._jvm.java.io.File(f.removeprefix("file:").replace("///", "/")).exists()]
    staging.drop_staged(last)
    assert staging.mark() == mark
