import datetime as dt

import pytest

from cohortkit.params import KpiParams


def test_defaults_and_strings():
    p = KpiParams(start="2000-10-01", end="2001-01-01")
    assert p.start == dt.date(2000, 10, 1) and p.end == dt.date(2001, 1, 1)
    assert p.replace(distributor="%").distributor == "%"


@pytest.mark.parametrize("kw", [
    dict(start=dt.date(2001, 1, 1), end=dt.date(2001, 1, 1)),
    dict(retain_start=dt.date(2000, 6, 1), ytd_start=dt.date(2000, 1, 1)),
    dict(recency_edges=(90, 90, 270, 360)),
    dict(recency_edges=(90, 180, 270)),
    dict(distributor=""),
])
def test_rejects_bad_values(kw):
    with pytest.raises(ValueError):
        KpiParams(**kw)


def test_checkpoint_dir_needs_a_shared_folder_off_local():
    from cohortkit.session import ensure_checkpoint_dir

    class Ctx:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Ctx()
        conf = Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
