"""A small raw data set: one line per record, `-` for NULL, columns as in Bronze."""

from ledgerlark.schemas import BRONZE

OBSERVED = "2023-07-01"
AS_OF = "2024-12-31"

TEXT = {
    "users": """
        ana|2022-11-03 09:00:00|CL|2022-11-03 09:00:00|2022-11-03 09:05:00
        ana|2022-11-03 09:00:00|PE|2022-12-01 10:00:00|2022-12-01 10:05:00
        bruno|2022/11/20 18:30:00|UY|2022/11/20 18:30:00|2022/11/20 18:30:00
        carla|15-01-2023 07:45:00|CO|15-01-2023 07:45:00|2023-01-15 08:00:00
        dario|15/01/2023 07:45:00|EC|2023-01-16 07:45:00|2023-01-16 08:00:00
        -|2023-02-01 00:00:00|CL|2023-02-01 00:00:00|2023-02-01 00:00:00
    """,
    "user_sessions": """
        s1|ana|2023-06-01 00:00:00
        s2|ana|2023-05-31 23:59:59
        s3|ana|2023-07-01 23:59:59
        s4|ana|2023-07-02 00:00:00
        s5|ana|2023-06-10 08:00:00
        s6|ana|2023-06-10 21:00:00
        s7|bruno|20-06-2023 10:00:00
        s8|bruno|not a time
        s9|-|2023-06-11 08:00:00
        -|bruno|2023-06-11 08:00:00
    """,
    "loans": """
        a1|ana|2023-06-15|700.25|12|2023-06-15 09:00:00|2023-06-15 09:00:00
        a2|ana|2023-05-31|90|6|2023-05-31 09:00:00|2023-05-31 09:00:00
        b1|bruno|2023/07/01|1000|12|2023-07-01 09:00:00|2023-07-01 09:00:00
        b1|bruno|2023/07/01|1250|12|2023-07-02 09:00:00|2023-07-02 09:00:00
        c1|carla|01-06-2023|300.5|12.5|2023-06-01 09:00:00|2023-06-01 09:00:00
        d1|dario|2023-06-20|lots|12|2023-06-20 09:00:00|2023-06-20 09:00:00
        d2|dario|someday|10|12|2023-06-20 09:00:00|2023-06-20 09:00:00
        d3|dario|2023-06-20|40|12|2023-06-20 09:00:00|2023-06-20 09:00:00
        d3|dario|2023-06-20|bad|12|2023-06-21 09:00:00|2023-06-21 09:00:00
        -|dario|2023-06-20|40|12|2023-06-20 09:00:00|2023-06-20 09:00:00
        x1|-|2023-06-20|40|12|2023-06-20 09:00:00|2023-06-20 09:00:00
    """,
    "loan_payments": """
        p1|a1|2023-08-01|2023-08-31|50|50|2023-08-31 09:00:00|2023-08-31 09:00:00
        p2|a1|2023-09-01|2023-09-20|50|50|2023-09-20 09:00:00|2023-09-20 09:00:00
        p3|b1|2023-08-01|2023-09-01|80|1|2023-09-01 09:00:00|2023-09-01 09:00:00
        p4|c1|2024-07-01|-|25|0|2024-07-01 09:00:00|2024-07-01 09:00:00
        p5|c1|2024-07-02|-|25|0|2024-07-02 09:00:00|2024-07-02 09:00:00
        p6|a1|2023-07-01|2023-12-01|50|50|2023-12-01 09:00:00|2023-12-01 09:00:00
        p7|zz|2023-08-01|2023-12-01|50|50|2023-12-01 09:00:00|2023-12-01 09:00:00
        p8|a1|01/08/2023|2023-12-01|50|50|2023-12-01 09:00:00|2023-12-01 09:00:00
        p9|a1|2023-10-01|someday|50|-|2023-12-01 09:00:00|2023-12-01 09:00:00
        p9|a1|2023-10-01|2023-10-02|50|50|2023-12-02 09:00:00|2023-12-02 09:00:00
        -|a1|2023-10-01|2023-12-01|50|50|2023-12-01 09:00:00|2023-12-01 09:00:00
    """,
}

RAW = {
    table: [
        {
            name: None if cell == "-" else cell
            for name, cell in zip(BRONZE[table].fieldNames(), line.strip().split("|"))
        }
        for line in text.strip().splitlines()
    ]
    for table, text in TEXT.items()
}
