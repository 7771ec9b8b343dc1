import math

import pytest

from tabwright.functions import distributions as d


@pytest.mark.parametrize(
    "t, df, p", [(12.706204736, 1, 0.05), (4.30265273, 2, 0.05), (2.228138852, 10, 0.05), (2.0, 60, 0.0500330), (1.959963985, 1e9, 0.05)]
)
def test_student_t_two_sided(t, df, p):
    assert d.t_two_sided(t, df) == pytest.approx(p, abs=1e-6)


def test_student_t_sides_add_up():
    assert d.t_upper(1.3, 7) + d.t_upper(-1.3, 7) == pytest.approx(1.0)


@pytest.mark.parametrize("df, q", [(4, 2.7764451052), (9, 2.2621571628), (99, 1.9842169516)])
def test_student_t_quantile(df, q):
    assert d.t_quantile(0.975, df) == pytest.approx(q, abs=1e-8)


@pytest.mark.parametrize("x, df, p", [(3.841458821, 1, 0.05), (5.991464547, 2, 0.05), (18.30703805, 10, 0.05), (0.5, 10, 0.9999934)])
def test_chi_square(x, df, p):
    assert d.gamma_upper(df / 2, x / 2) == pytest.approx(p, abs=1e-6)


def test_normal_quantile():
    assert d.normal_quantile(0.975) == pytest.approx(1.959963984540054)


def test_alternatives():
    z = 1.2
    up, down = d.p_from(d.normal_upper, z, "greater"), d.p_from(d.normal_upper, z, "less")
    assert up + down == pytest.approx(1.0)
    assert d.p_from(d.normal_upper, z, "two-sided") == pytest.approx(2 * min(up, down))
    with pytest.raises(ValueError):
        d.check_alternative("sideways")


def test_beta_edges():
    assert d.beta_cdf(2, 3, 0) == 0 and d.beta_cdf(2, 3, 1) == 1
    assert d.beta_cdf(1, 1, 0.3) == pytest.approx(0.3)
    assert math.isclose(d.gamma_upper(1, 2), math.exp(-2))


@pytest.mark.parametrize(
    "df, p, q",
    [(1, 0.7048327646991335, 12.706204736432095), (30, 0.6207230048851, 2.0422724563012373), (1e6, 0.6170751874724, 1.9599663569),
     (1e10, 0.6170750774630, 1.9599639847772), (1e12, 0.6170750774520835, 1.9599639845424)],
)
def test_student_t_keeps_its_digits_for_any_degrees_of_freedom(df, p, q):
    assert d.t_two_sided(0.5, df) == pytest.approx(p, abs=1e-10)
    assert d.t_quantile(0.975, df) == pytest.approx(q, abs=1e-9)


def test_the_two_ways_meet(monkeypatch):
    for t in (0.1, 1.0, 3.0, 6.0):
        near = d.t_two_sided(t, 2e6)
        monkeypatch.setattr(d, "NEARLY_NORMAL", 1e9)
        assert d.t_two_sided(t, 2e6) == pytest.approx(near, abs=1e-9)
        monkeypatch.undo()


def test_arrays_equal_single_values():
    ts, dfs = [0.0, -1.5, 2.0, 40.0], [3.0, 10.0, 1e7, 5.0]
    assert d.t_two_sided(ts, dfs).tolist() == [d.t_two_sided(t, v) for t, v in zip(ts, dfs)]
    assert d.t_quantile(0.9, dfs).tolist() == pytest.approx([d.t_quantile(0.9, v) for v in dfs])
