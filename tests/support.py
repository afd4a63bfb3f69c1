"""Constants and helpers that the core tests share (a module of its own: ``conftest`` is no import name)."""

from __future__ import annotations

import os

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("OPSCORE_TEST_SF", SF_SMALL)


def make_df(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


BANDS_UP = dict(m_alerta=0.5, m_bronze=0.6, m_prata=0.7, m_ouro=0.8, m_1=0.9, m_2=1.0,
                p_alerta=0.0, p_bronze=10.0, p_prata=20.0, p_ouro=30.0, p_1=40.0, p_2=50.0)
BANDS_DOWN = dict(BANDS_UP, m_alerta=0.5, m_bronze=0.4, m_prata=0.3, m_ouro=0.2, m_1=0.1,
                  m_2=0.05)
