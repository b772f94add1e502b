"""The library's operators run on the driver's tables, and the SQL each must agree with.

Stand-ins: commune = supplier, department = nation, sale and diagnosis = lineitem, run = event,
population = orders per customer, income = part. Every query reads its tables whole.
"""
