"""Given models for the queries whose result must not depend on a fit."""

from __future__ import annotations

from modeforge.operators.model import Mixture

# Four components over events.value; the last one is too light to be active.
EVENT_VALUE = Mixture(
    means=(12.0, 45.0, 110.0, 300.0),
    variances=(60.0, 260.0, 1500.0, 9000.0),
    beta=(4001.0, 3501.0, 2401.0, 41.0),
    nu=(4001.0, 3501.0, 2401.0, 41.0),
    a=(4001.0, 3501.0, 2401.0, 41.0),
    b=(5940.001, 2440.001, 40.001, 0.001),
    active=(True, True, True, False),
    frequency=(3500.0, 4100.0, 2400.0, 0.0),
)

# Two components over lineitem.l_discount without its zeros.
DISCOUNT = Mixture(
    means=(0.03, 0.075),
    variances=(0.0002, 0.0003),
    beta=(27001.0, 27001.0),
    nu=(27001.0, 27001.0),
    a=(27001.0, 27001.0),
    b=(27000.001, 0.001),
    active=(True, True),
    frequency=(26000.0, 28000.0),
)

# Three components over all of lineitem.l_discount, zeros included.
DISCOUNT_WHOLE = Mixture(
    means=(0.002, 0.035, 0.08),
    variances=(0.00001, 0.0002, 0.0003),
    beta=(6001.0, 27001.0, 27001.0),
    nu=(6001.0, 27001.0, 27001.0),
    a=(6001.0, 27001.0, 27001.0),
    b=(54000.001, 27000.001, 0.001),
    active=(True, True, True),
    frequency=(6000.0, 26000.0, 28000.0),
)

# Two components over orders.o_totalprice.
TOTAL_PRICE = Mixture(
    means=(130000.0, 370000.0),
    variances=(5.0e9, 6.0e9),
    beta=(7501.0, 7501.0),
    nu=(7501.0, 7501.0),
    a=(7501.0, 7501.0),
    b=(7500.001, 0.001),
    active=(True, True),
    frequency=(7600.0, 7400.0),
)

# Two components over lineitem.l_extendedprice.
EXTENDED_PRICE = Mixture(
    means=(27000.0, 78000.0),
    variances=(2.2e8, 2.5e8),
    beta=(30001.0, 30001.0),
    nu=(30001.0, 30001.0),
    a=(30001.0, 30001.0),
    b=(30000.001, 0.001),
    active=(True, True),
    frequency=(29000.0, 31000.0),
)
