from .contact import (contact_class, contact_class_dashboard, contact_case_sql, evolution_class,
                      is_target_zone, levels, population_class)
from .dates import (coerce_timestamp, decimal_comma, first_number, label_board_week, label_day_month,
                    label_iso, label_stamp, pct_with_count, share_pct, week_monday, week_sunday)
from .ids import dni_cascade, with_dni
from .text import blank_markers, clean_closing_text, clean_name
