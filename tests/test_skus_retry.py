from decimal import Decimal

from pyspark.sql import functions as F

from conftest import at, frame, values
from syncloom.operators import retry, skus as sk
from syncloom.operators.payloads import asset_payload, prior_attributes, sku_payload
from syncloom.schemas import STATE

KEY = "company string, branch string, category decimal(3,0), class_code decimal(4,0)"
NOW = at("2024-02-01")
EARLIER = at("2024-01-01")


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def active(spark):
    return frame(spark, [("01", "b1", 1), ("01", "b2", 2)], "company string, branch string, id bigint")


def master(spark):
    return frame(
        spark, [("01", 9, 5, "drill", "N", "D "), ("01", 9, 6, "cone", "Y", "C ")],
        "company string, category decimal(3,0), class_code decimal(4,0), "
        "description string, bulk string, item string",
    )


def assets(spark):
    return frame(
        spark, [("01", "a1", 9, 5, "b2", "b1", "A", "A", " s1 "), ("01", "a2", 9, 5, "b1", "b1", "I", "A", "s2"),
         ("01", "a3", 9, 5, "b1", "b2", "A", "D", "s3"), ("01", "a4", 9, 6, "b1", "b2", "A", "A", "s4"),
         ("01", "a5", 9, 5, "b1", "b9", "A", "A", "s5")],
        "company string, asset_id string, category decimal(3,0), class_code decimal(4,0), "
        "home_branch string, current_branch string, status string, delete_code string, serial string",
    )


def asset_changes(spark, *ids):
    return frame(
        spark, [("01", i, "UPD") for i in ids], "company string, asset_id string, change_type string"
    )


def test_skus_of_assets_are_distinct_live_active_and_not_bulk(spark):
    changed = asset_changes(spark, "a1", "a2", "a3", "a4", "a5")
    found = sk.skus_of_assets(changed, assets(spark), master(spark), active(spark))
    assert values(found, "pc_id", "branch", "upc", "product_id", "label", "description", "is_bulk") == [
        (1, "b1", "009", "0005", "009-0005", "drill", False)
    ]


def queue_rows(spark, *rows):
    """Bulk queue entries of (branch, class, qty, sent)."""
    return frame(
        spark, [("r0", "01", b, 9, c, q, "RC", 1, EARLIER, s) for b, c, q, s in rows], STATE["bulk_queue"]
    )


def test_queued_bulk_skus_per_branch_and_for_all(spark):
    listed = sk.skus_of_quantities(
        frame(spark, [("01", "b1", 9, 6)], KEY), master(spark), active(spark)
    )
    queue = queue_rows(spark, ("b1", 6, Decimal(1), None), ("b2", 6, Decimal(1), None), ("b2", 6, Decimal(0), None))
    args = (queue, master(spark), active(spark), listed)
    assert values(sk.skus_of_queued_bulk(*args), "branch") == [("b2",)]
    assert sk.skus_of_queued_bulk(*args, per_branch=False).isEmpty()
    sent = queue.withColumn("sent_at", F.lit(EARLIER).cast("timestamp_ntz"))
    assert sk.skus_of_queued_bulk(sent, *args[1:]).isEmpty()
    assert values(sk.skus_of_queued_bulk(sent, *args[1:], include_sent=True), "branch") == [("b2",)]


def skus(spark, *ids):
    """SKU list of (branch, class, sku id, bulk)."""
    return frame(
        spark, [("01", b, 9, c, i, bulk) for b, c, i, bulk in ids], f"{KEY}, sku_id bigint, is_bulk boolean"
    )


def test_resolution_compares_padded_texts_and_marks_what_is_missing(spark):
    rows = frame(spark, [("01", "b1", 9, 6), ("01", "b2", 9, 6)], KEY)
    listed = sk.skus_of_quantities(rows, master(spark), active(spark))
    remote = frame(
        spark, [(1, "009", "0006", 77), (2, "9", "6", 78)], "location_id bigint, upc string, product_id string, sku_id bigint"
    )
    assert values(sk.resolve_skus(listed, remote), "branch", "location_id", "sku_id") == [("b1", 1, 77), ("b2", 2, 0)]
    flagged = sk.flag_missing(listed, remote)
    assert values(flagged, "branch", "action") == [("b1", 0), ("b2", 1)]
    assert values(sk.missing_skus(listed, remote), "branch") == [("b2",)]
    assert sku_payload(flagged, now()).count() == 2
    assert values(sku_payload(flagged, now(), only_missing=True), "HQLocationID") == [(2,)]


def to_send(spark, *rows):
    return frame(
        spark, [("01", b, 9, c, q, "RC") for b, c, q in rows], f"{KEY}, qty decimal(16,0), status string"
    )


def test_bulk_without_id_waits_and_with_id_goes_out_with_what_waited(spark):
    sending = to_send(spark, ("b1", 6, 5), ("b2", 6, 4), ("b2", 7, 3), ("b9", 6, 2))
    known = skus(spark, ("b1", 6, 77, True), ("b2", 6, 0, True), ("b2", 7, 79, False))
    queue = queue_rows(
        spark, ("b1", 6, Decimal("2.5"), None), ("b1", 6, Decimal("1.5"), None), ("b1", 6, Decimal(9), EARLIER), ("b2", 6, Decimal(1), None)
    )
    held = retry.hold_back_bulk(sending, known, active(spark), queue, "r1", now())
    assert values(held, "run_id", "branch", "class_code", "qty", "sent_at") == [
        ("r1", "b2", 6, 4, None), ("r1", "b2", 7, 3, None)
    ]
    merged = retry.merge_held(queue, held)
    # What b2 was to get is one entry now: 1 that waited and 4 on top.
    assert values(retry.unsent(merged), "run_id", "branch", "class_code", "qty") == [
        ("r0", "b1", 6, 1.5), ("r0", "b1", 6, 2.5), ("r0", "b2", 6, 5), ("r1", "b2", 7, 3)
    ]
    assert values(merged.where("sent_at is not null"), "branch", "qty") == [("b1", 9)]
    after, _ = retry.append_capture(queue, held)
    replayed = retry.replay_quantities(after, sk.resolved(known, is_bulk=True))
    assert values(replayed, "branch", "qty") == [("b1", 4)]
    sent = retry.send_list(sending.where("branch <> 'b9'"), replayed, held)
    assert values(sent, "branch", "qty", "source_rank") == [("b1", 4, 1), ("b1", 5, 0)]
    marked = retry.mark_sent(after, sent, ["company", "branch", "category", "class_code"], "r1", now())
    assert values(marked, "branch", "qty", "run_id", "sent_at") == sorted(
        [("b1", 2.5, "r1", NOW), ("b1", 1.5, "r1", NOW), ("b1", 9, "r0", EARLIER),
         ("b2", 1, "r0", None), ("b2", 4, "r1", None), ("b2", 3, "r1", None)], key=repr
    )


def asset_queue(spark, *rows):
    """Asset queue entries of (asset, branch, sent)."""
    return frame(
        spark, [("r0", "01", a, b, "009", "0005", 1, EARLIER, s) for a, b, s in rows], STATE["asset_queue"]
    )


def test_assets_wait_once_and_settle_when_their_sku_arrives(spark):
    everything = assets(spark)
    changed = asset_changes(spark, "a1", "a2", "a3", "a4")
    queue = asset_queue(spark, ("a1", "b1", None), ("a3", "b2", None), ("a4", "b2", EARLIER))
    known = skus(spark, ("b1", 5, 70, False), ("b2", 5, 0, False))
    held = retry.hold_back_assets(changed, everything, known, active(spark), queue, "r1", now())
    # a1 and a2 resolve, a3 waits already, a4 waited once but was sent.
    assert values(held, "asset_id", "branch", "category", "class_code") == [("a4", "b2", "009", "0006")]
    after, _ = retry.append_capture(queue, held)
    remaining, settled = retry.settle_assets(changed, everything, after, known, active(spark), "r1", now())
    assert values(remaining, "asset_id") == [("a1",), ("a2",)]
    assert values(settled, "asset_id", "run_id", "sent_at") == [
        ("a1", "r1", NOW), ("a3", "r0", None), ("a4", "r0", EARLIER), ("a4", "r1", None)
    ]


def test_every_change_is_sent_or_waits_but_never_both(spark):
    changed = asset_changes(spark, "a1", "a2", "a3", "a4")
    queue = asset_queue(spark, ("a3", "b2", None))
    known = skus(spark, ("b1", 5, 70, False))
    held = retry.hold_back_assets(changed, assets(spark), known, active(spark), queue, "r1", now())
    after, _ = retry.append_capture(queue, held)
    remaining, settled = retry.settle_assets(
        changed, assets(spark), after, known, active(spark), "r1", now()
    )
    sent = {r[0] for r in values(remaining, "asset_id")}
    waiting = {r[0] for r in values(retry.unsent(settled), "asset_id")}
    assert sent | waiting == {"a1", "a2", "a3", "a4"} and not sent & waiting


def test_assets_settle_by_where_they_are_now(spark):
    """a1 waited at b2 and is at b1 now, which resolves; a3 waited at b1 and is at b2, which does not."""
    everything = assets(spark)
    changed = asset_changes(spark, "a1", "a3")
    queue = asset_queue(spark, ("a1", "b2", None), ("a3", "b1", None))
    known = skus(spark, ("b1", 5, 70, False))
    held = retry.hold_back_assets(changed, everything, known, active(spark), queue, "r1", now())
    assert values(held, "asset_id", "branch") == [("a3", "b2")]
    after, _ = retry.append_capture(queue, held)
    remaining, settled = retry.settle_assets(changed, everything, after, known, active(spark), "r1", now())
    assert values(remaining, "asset_id") == [("a1",)]
    assert values(settled, "asset_id", "branch", "run_id", "sent_at") == [
        ("a1", "b2", "r1", NOW), ("a3", "b1", "r1", NOW), ("a3", "b2", "r1", None)
    ]


def test_an_asset_whose_sku_turned_bulk_goes_on_waiting(spark):
    changed = asset_changes(spark, "a1")
    queue = asset_queue(spark, ("a1", "b1", None))
    known = skus(spark, ("b1", 5, 70, True))
    held = retry.hold_back_assets(changed, assets(spark), known, active(spark), queue, "r1", now())
    after, _ = retry.append_capture(queue, held)
    remaining, settled = retry.settle_assets(changed, assets(spark), after, known, active(spark), "r1", now())
    assert values(remaining, "asset_id") == []
    assert values(retry.unsent(settled), "asset_id", "branch") == [("a1", "b1")]


def test_payload_shows_serial_numbers_now_and_before(spark):
    prior = prior_attributes(assets(spark), active(spark))
    assert values(prior) == [("01", "a1", "s1"), ("01", "a3", "s3"), ("01", "a4", "s4"), ("01", "a5", "s5")]
    known = skus(spark, ("b1", 5, 70, False))
    renumbered = assets(spark).withColumn("serial", F.concat(F.lit(" new"), F.trim("serial")))
    sent = asset_payload(asset_changes(spark, "a1", "a2"), renumbered, active(spark), known, prior, now())
    assert values(sent, "HQLocationID", "HQSKUID", "TagID", "SerialNumber", "PrevSerial") == [
        (1, 70, "a1", "news1", "s1"), (1, 70, "a2", "news2", None)
    ]


def test_settling_reads_where_assets_are_once(spark):
    """Sent, waiting, moved and unknown assets, and entries with a NULL, in one pass over the queue."""
    assets = spark.createDataFrame(
        [("01", a, b, c, 5) for a, b, c in [("a", "0001", 1), ("b", "0002", 2), ("c", "0002", 2), ("d", "0009", 1)]],
        "company string, asset_id string, current_branch string, category int, class_code int",
    )
    changes = assets.select("company", "asset_id").withColumn("change_type", F.lit("UPD"))
    skus = spark.createDataFrame(
        [("01", "0001", 1, 5, False, 7), ("01", "0002", 2, 5, False, 0)],
        "company string, branch string, category int, class_code int, is_bulk boolean, sku_id long",
    )
    active = spark.createDataFrame([(1, "01", "0001"), (2, "01", "0002")], "id long, company string, branch string")
    entries = [
        ("a", "0001", "001", None), ("a", "0002", "002", None), ("a", None, "001", None), ("b", "0002", "002", None),
        ("b", "0001", "001", None), ("c", "0002", "002", "r0"), ("d", "0009", "001", None), ("e", "0001", "001", None),
    ]
    queue = spark.createDataFrame(
        [("r0", "01", a, b, c, "0005", sent) for a, b, c, sent in entries],
        "run_id string, company string, asset_id string, branch string, category string, class_code string, sent_at string",
    )
    staged = []
    sendable, settled = retry.settle_assets(
        changes, assets, queue, skus, active, "r1", F.lit("now"), stage=lambda df: staged.append(df) or df
    )
    assert values(sendable, "asset_id") == [("a",)] and len(staged) == 1
    sent = {("a", "0001"), ("a", "0002"), ("b", "0001")}
    expected = [(a, b, "r1" if (a, b) in sent else "r0", "now" if (a, b) in sent else s) for a, b, _, s in entries]
    assert values(settled, "asset_id", "branch", "run_id", "sent_at") == sorted(expected, key=repr)
