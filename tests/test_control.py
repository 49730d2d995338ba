"""Control-table scan and load-type dispatch."""

from lakeops.operators.control import ControlEntry, LoadMode, control_scan, ingestion_scan, to_entries
from lakeops.plans import fixtures as fx

from conftest import SF_SMALL


def test_control_scan_filters_and_orders(spark):
    ctl = fx.control_table(spark, SF_SMALL)
    ids = [e.id for e in to_entries(control_scan(ctl, 1))]
    assert ids == [2, 3, 1, 4, 5, 6, 7]
    assert [e.id for e in to_entries(control_scan(ctl, 2))] == [10]
    assert 9 in [e.id for e in to_entries(ingestion_scan(ctl, 1))]
    assert control_scan(ctl, 1).schema["startdatetime"].dataType.typeName() == "timestamp_ntz"


def test_load_mode_dispatch():
    def mode(load, off=None):
        return ControlEntry(1, 1, "q", "x", "t", load, offset_value=off).mode
    assert mode("Full Load") is LoadMode.FULL
    assert mode("full load") is None          # exact match only
    assert mode("MERGE") is LoadMode.WINDOW   # case-insensitive
    assert mode("Incremental", 5) is LoadMode.OFFSET
    assert mode("Snapshot") is None
    assert ControlEntry(1, 1, "q", "oracle", "t", "merge").dialect == "oracle"
    assert ControlEntry(1, 1, "q", "Oracle", "t", "merge").dialect == "generic"
