"""Column expressions shared by the plans: keys, casts, dates, flags."""
