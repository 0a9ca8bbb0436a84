from tickcast.__main__ import main
from tickcast.session import scratch_path
from tickcast.sources import proxy
from tickcast.sources.sinks import land, read_documents

SF = "/root/testdata/sf0.001"


def test_batch_command_writes_documents(spark):
    base = scratch_path(spark, "test-cli")
    land(proxy.event_news_documents(spark, SF), f"{base}/landing", "news")
    land(proxy.event_price_documents(spark, SF), f"{base}/landing", "prices")
    proxy.quote_payloads(proxy.event_bars(spark, SF)).write.parquet(f"{base}/quotes")
    args = ["--landing", f"{base}/landing", "--formatted", f"{base}/formatted", "--documents", f"{base}/documents",
            "--checkpoint", f"{base}/ckpt", "--as-of", "2024-01-25", "--quotes", f"{base}/quotes"]
    main(["batch", *args])
    docs = read_documents(spark, f"{base}/documents")
    assert docs.count() > 0 and docs.filter("current_price IS NULL").count() == 0
