"""A small untidy booking file: one row per case the layers must get right."""

HEADER = (" Date,Time,Booking ID,Booking Status,Customer ID,Vehicle Type,Pickup Location,Drop Location,Avg VTAT,"
          "Avg CTAT,Cancelled Rides by Customer,Reason for cancelling by Customer,Cancelled Rides by Driver,"
          "Driver Cancellation Reason,Incomplete Rides,Incomplete Rides Reason,Booking Value,Ride Distance,"
          "Driver Ratings,Customer Rating,Payment Method")

# Columns given: date, time, id, status, customer, vehicle, pickup, drop, by customer, by driver, incomplete,
# incomplete reason, value, distance, payment.
CASES = [
    # quoted id, blanks around values
    ("2024-03-01", "08:15:00", '"""CNR1"""', "Completed", '"""C1"""', " Auto ", "North", "South", "", "", "", "",
     "100.25", "5.5", "UPI"),
    # exact duplicate
    ("2024-03-01", "08:15:00", '"""CNR1"""', "Completed", '"""C1"""', " Auto ", "North", "South", "", "", "", "",
     "100.25", "5.5", "UPI"),
    # one booking id, two customers, cancelled first and then completed
    ("2024-03-02", "09:00:00", "CNR2", "Cancelled by Customer", "C2", "Bike", "North", "East", "1", "", "", "",
     "null", "NaN", ""),
    ("2024-03-02", "09:30:00", "CNR2", "Completed", "C3", "Bike", "North", "East", "", "", "", "", "50.10", "2",
     "Cash"),
    # no customer, no vehicle, no drop
    ("2024-03-31", "23:59:59", "CNR3", "Completed", "NA", "null", "West", "", "", "", "", "", "20", "1", "UPI"),
    # no booking id, twice, cancelled by the driver
    ("2024-03-05", "10:00:00", "", "Cancelled by Driver", "C4", "Auto", "South", "North", "", "1", "", "", "", "",
     "None"),
    ("2024-03-06", "11:00:00", "N/A", "Cancelled by Driver", "C4", "Auto", "South", "North", "", "1", "", "", "", "",
     ""),
    # incomplete, without a value
    ("2024-03-07", "12:00:00", "CNR5", "Incomplete", "C5", "Auto", "South", "Island", "", "", "1", "Breakdown", "", "",
     ""),
    # last day of February and first of April
    ("2024-02-29", "01:00:00", "CNR6", "Completed", "C1", "Auto", "East", "South", "", "", "", "", "10.50", "3",
     "UPI"),
    ("2024-04-01", "02:00:00", "CNR7", "Completed", "C1", "Bike", "East", "Harbour", "", "", "", "", "30", "4", "Cash"),
    # no such day
    ("2024-13-01", "03:00:00", "CNR8", "Completed", "C9", "Auto", "East", "South", "", "", "", "", "1", "1", "UPI"),
]


def line(case):
    (day, time, booking, status, customer, vehicle, pickup, drop, by_customer, by_driver, incomplete, why, value,
     distance, payment) = case
    return ",".join([day, time, booking, status, customer, vehicle, pickup, drop, "", "", by_customer, "", by_driver,
                     "", incomplete, why, value, distance, "4.5", "4.0", payment])


def write(folder, cases=None, name="rides.csv"):
    path = f"{folder}/{name}"
    with open(path, "w") as out:
        out.write("\n".join([HEADER, *map(line, CASES if cases is None else cases)]) + "\n")
    return path
