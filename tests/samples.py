"""Own small sample files for the golden tests, in the formats of FIXTURES.md section 1.

The rows are made here; the expected results stand in the tests.
"""

import os

SENSOR_TXT, OUTPUT2, DATA_TXT = "sensor.txt", "output2", "data.txt"
LOGIN_LOG, ORDER_LOG, RECEIPT_LOG, AD_CLICK_LOG = "LoginLog.csv", "OrderLog.csv", "ReceiptLog.csv", "AdClickLog.csv"

T0 = 1_700_000_000  # a multiple of 10 seconds

#: sensor_1 five times, three others once; two readings below 30 degrees
SENSORS = [("sensor_1", -5, 30.5), ("sensor_6", 1, 12.5), ("sensor_7", 2, 8.0), ("sensor_10", 5, 41.0),
           ("sensor_1", 6, 36.5), ("sensor_1", 8, 33.0), ("sensor_1", 9, 40.0), ("sensor_1", 92, 38.0)]

TEXT = ["hello wide world", "hello green tree", "hello you", "are you there", "yes", "you said so"]

#: user 41 fails at seconds 42, 43, 44 and 46; the fail of second 46 arrives before that of 43
LOGINS = ([(100 + i, "success", 10 + i) for i in range(20)]
          + [(41, "fail", 42), (7, "fail", 42), (7, "success", 43), (41, "fail", 46), (41, "fail", 43), (41, "fail", 44)]
          + [(200 + i, "success", 50 + i) for i in range(20)])

#: orders 1 to 30 are paid after 60 + 10 i seconds, but 31 and 32 after more than 15 minutes;
#: order 33 has a payment only
ORDERS = sorted([(i, "create", "", 10 * i) for i in range(1, 33)]
                + [(i, "pay", f"tx{i:02d}", 10 * i + 60 + 10 * i) for i in range(1, 31)]
                + [(31, "pay", "tx31", 310 + 901), (32, "pay", "tx32", 320 + 1500), (33, "pay", "tx33", 333)],
                key=lambda r: r[3])

#: receipts of payments 1 to 28: the first six within 5 seconds, the others 30 seconds late;
#: two receipts have no payment
RECEIPTS = sorted([(f"tx{i:02d}", "card", 20 * i + 60 + (i - 1 if i <= 6 else 30)) for i in range(1, 29)]
                  + [("none1", "bank", 100), ("none2", "bank", 200)], key=lambda r: r[2])

#: one user clicks one ad 121 times; others click a few times
CLICKS = sorted([(900, 17, "north", "n1", 3 * i) for i in range(121)]
                + [(i, i % 4, ("south", "east", "west")[i % 3], "c", 7 * i) for i in range(1, 25)], key=lambda r: r[4])


def write(folder: str) -> None:
    """All files; no header rows, the last line without a newline."""
    files = {
        SENSOR_TXT: [f"{i}, {T0 + t}, {v}" for i, t, v in SENSORS],
        OUTPUT2: [f"{i},{v}" for i, _, v in SENSORS if i == "sensor_1"],
        DATA_TXT: TEXT,
        LOGIN_LOG: [f"{u},10.0.0.{u % 200},{e},{T0 + t}" for u, e, t in LOGINS],
        ORDER_LOG: [f"{o},{e},{x},{T0 + t}" for o, e, x, t in ORDERS],
        RECEIPT_LOG: [f"{x},{c},{T0 + t}" for x, c, t in RECEIPTS],
        AD_CLICK_LOG: [f"{u},{a},{p},{c},{T0 + t}" for u, a, p, c, t in CLICKS],
    }
    for name, lines in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write("\n".join(lines))
