"""Industry code sets shared by the segments.

Codes are characters 2-5 of a loan's industry direction code.
"""

# Industries of culture and related sectors, in source order.
CULTURE_INDUSTRIES = """
    8610 8622 8710 8720 8740 6421 6429 8621 8623 8624 8625 8626 8629 8730 8770 8810 8870 8890 6572
    6422 8831 8832 8840 8850 8860 2431 2432 2433 2434 2435 2436 2437 2438 2439 3075 3076 7251 7259
    7491 7492 5143 5144 5145 5243 5244 7124 7125 6321 6322 6331 8750 8760 8820 5183 5184 5146 5245
    5246 9011 9012 9013 9019 9020 9090 7850 7861 7862 7869 7712 7715 7716 9030 5622 2222 2642 2644
    2664 2311 2312 2319 2320 2330 8060 7281 7284 7289 9051 9053 9059 7298 7121 7123 7350 8393 3542
    3474 3931 3932 3933 3934 3939 5178 3471 3953 3472 3473 5248 3873 2461 2462 2469 2421 2422 2423
    2429 5147 5247 2411 5141 5241 2412 2414 2451 2456 2459 2672 3951 3952 5137 5271 5149 5249
""".split()

# Industries counted as technical upgrading of industrial
# enterprises, in source order.
UPGRADE_INDUSTRIES = """
    2710 2720 2730 2740 2750 2761 2762 2770 2780 3741 3742 3743 3744 3749 4343 3562 3563 3569 3832
    3833 3841 3921 3922 3940 3931 3932 3933 3934 3939 3951 3952 3953 3971 3972 3973 3974 3975 3976
    3979 3981 3982 3983 3984 3985 3989 3961 3962 3963 3969 3990 3911 3912 3913 3914 3915 3919 3474
    3475 3581 3582 3583 3584 3585 3586 3589 4011 4012 4013 4014 4015 4016 4019 4021 4022 4023 4024
    4025 4026 4027 4028 4029 4040 4090 2664 2665
""".split()
