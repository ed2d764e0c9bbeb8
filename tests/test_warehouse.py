"""End to end from exported CSV files in the raw layout (string ids,
True/False, 'yyyy-MM-dd HH:mm:ss', empty = null)."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from churnlab.plans import checks as C
from churnlab.plans import models as M
from churnlab.plans.registry import QUERIES, all_tables
from churnlab.settings import Settings
from churnlab.sources.io import MissingSourceError
from churnlab.sources.lookups import ACCEPTED_CHANNELS, ACCEPTED_STATUSES, CHANNEL_CAC, EFFECT_SCHEMA, PLANS, literal_table
from churnlab.sources.warehouse import sources_from_files


def csv_text(header: str, rows: list[tuple]) -> str:
    return "\n".join([header, *(",".join(map(str, row)) for row in rows)]) + "\n"


FILES = {
    "plans.csv": csv_text("plan_id,plan_name,price_monthly,billing_period,max_streams,resolution", PLANS),
    "content_catalog.csv": """content_id,title,content_type,genre,release_year,duration_minutes,is_original
c_0000,Alpha,series,Drama,2020,45,True
c_0001,Beta,movie,Comedy,2019,110,False
""",
    "users.csv": """user_id,signup_date,signup_timestamp,acquisition_channel,country,primary_device,age,email
u_0000000,2024-06-03,2024-06-03 10:15:00,organic,US,mobile,31,a@example.com
u_0000001,2024-06-05,2024-06-05 21:40:00,paid_social,CA,smart_tv,44,b@example.com
u_0000002,2024-06-09,2024-06-09 08:05:00,referral,UK,desktop,,
""",
    "experiments.csv": """experiment_id,experiment_name,variant,start_date,end_date,is_control
x_tour,Guided tour,control_off,2024-05-15,2024-07-20,True
x_tour,Guided tour,tour_on,2024-05-15,2024-07-20,False
""",
    "experiment_assignments.csv": """experiment_id,user_id,variant,assigned_at
x_tour,u_0000000,control_off,2024-06-03 10:15:00
x_tour,u_0000001,tour_on,2024-06-05 21:40:00
""",
    "subscriptions.csv": """subscription_id,user_id,plan_id,status,started_at,ended_at,is_trial,converted_to_paid,mrr
s_0000000,u_0000000,2,active,2024-06-10 11:15:00,,False,True,12.99
s_0000001,u_0000001,4,churned,2024-06-20 22:40:00,2025-06-20 22:40:00,False,True,10.0
s_0000002,u_0000002,1,trial_expired,2024-06-09 10:05:00,2024-06-16 10:05:00,True,False,0.0
""",
    "events.csv": """event_id,user_id,event_type,event_timestamp
e_00000000,u_0000000,page_view,2024-06-03 10:00:00
e_00000001,u_0000000,signup_completed,2024-06-03 10:15:00
e_00000002,u_0000000,subscribed,2024-06-10 11:15:00
e_00000003,u_0000002,signup_completed,2024-06-09 08:05:00
""",
    "sessions.csv": """session_id,user_id,session_date,session_start,duration_minutes,device
sess_000000000,u_0000000,2024-06-04,2024-06-04 20:00:00,35,mobile
sess_000000001,u_0000000,2024-06-04,2024-06-04 22:00:00,95,smart_tv
sess_000000002,u_0000000,2024-06-12,2024-06-12 19:00:00,20,mobile
sess_000000003,u_0000001,2024-07-10,2024-07-10 19:00:00,130,
""",
    "content_views.csv": """view_id,user_id,session_id,content_id,view_date,watch_percentage,completed
v_000000000,u_0000000,sess_000000000,c_0000,2024-06-04,1.0,True
v_000000001,u_0000000,sess_000000001,c_0001,2024-06-04,0.5,False
""",
    "channel_cac.csv": csv_text("acquisition_channel,channel_cac", CHANNEL_CAC),
}


def export(*without: str) -> str:
    folder = tempfile.mkdtemp(prefix="churnlab-raw-")
    for name, text in FILES.items():
        if name not in without:
            with open(os.path.join(folder, name), "w") as f:
                f.write(text)
    return folder


def test_missing_files_are_all_named(spark):
    folder = export("events.csv", "users.csv")
    with pytest.raises(MissingSourceError, match="users.csv.*events.csv"):
        sources_from_files(spark, folder, Settings(as_of=dt.date(2025, 12, 31)))
    with pytest.raises(MissingSourceError, match="channel_cac.csv"):
        sources_from_files(spark, export("channel_cac.csv"), Settings(as_of=dt.date(2025, 12, 31)))


def test_rules_without_their_input_raise(spark):
    s = sources_from_files(spark, export(), Settings(as_of=dt.date(2025, 12, 31)))
    for name in ("experiment_effects", "trial_period"):
        with pytest.raises(ValueError):
            QUERIES[name](s)
    effects = literal_table(spark, [("x_tour", "tour_on", Decimal("0.100"), Decimal("-0.020"))], EFFECT_SCHEMA)
    s = sources_from_files(spark, export(), s.settings, effects=effects, trial_experiment="x_tour")
    lifts = {r.user_id: r.signup_lift for r in QUERIES["experiment_effects"](s).collect()}
    assert lifts == {"u_0000000": 0, "u_0000001": Decimal("0.100"), "u_0000002": 0}
    days = {r.user_id: r.trial_days for r in QUERIES["trial_period"](s).collect()}
    assert (days["u_0000000"], days["u_0000001"]) == (7, 14)
    assert QUERIES["check_composite_key"](s).count() == 0


def test_models_from_exported_csv(spark):
    folder = export()
    s = sources_from_files(spark, folder, Settings(as_of=dt.date(2025, 12, 31), cap=dt.date(2025, 6, 1)))
    acq = {r.user_id: r for r in M.mart_acquisition(
        s.users, s.events, s.subscriptions, s.plans, s.channel_cac).collect()}
    assert acq["u_0000000"].reached_paid == 1 and acq["u_0000000"].plan_name == "Standard"
    assert acq["u_0000001"].channel_cac == 22 and acq["u_0000002"].converted_to_paid is False
    assert acq["u_0000000"].signup_week == dt.date(2024, 6, 2)  # Sunday week
    eco = M.mart_economics(s.subscriptions, s.users, s.plans, s.channel_cac, s.settings)
    months = {r.subscription_id: r for r in eco.groupBy("subscription_id").agg({"active_month": "max"}).collect()}
    assert months["s_0000000"][1] == dt.date(2025, 6, 1)  # open: capped
    assert months["s_0000001"][1] == dt.date(2025, 6, 1)  # ends 2025-06-20
    annual = eco.where("subscription_id = 's_0000001'").first()
    assert annual.mrr == Decimal("10.00") and annual.channel_cac == 22
    eng = {(r.user_id, r.session_date): r for r in M.mart_engagement(s.users, s.sessions).collect()}
    day = eng[("u_0000000", dt.date(2024, 6, 4))]
    assert (day.session_count, day.total_minutes, day.devices_list, day.engagement_tier) == (
        2, 130, "mobile,smart_tv", "power_user")
    assert eng[("u_0000001", dt.date(2024, 7, 10))].devices_list is None
    report = C.quality_report(all_tables(s), C.full_suite(s.accepted_channels, ACCEPTED_STATUSES))
    bad = {(r.table_name, r.column_name, r.check_name): r.violations for r in report.collect() if r.violations}
    assert bad == {} and s.accepted_channels == ACCEPTED_CHANNELS
    assert not [r for r in QUERIES["load_constraints"](s).collect() if r.violations]
