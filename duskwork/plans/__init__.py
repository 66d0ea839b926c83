"""The end-of-day jobs. Each is a function (tables, as_of) -> JobResult."""

from duskwork.plans.alerts import alert_by_account, alert_by_fund
from duskwork.plans.approvals import expire_approvals
from duskwork.plans.archive import archive_transactions
from duskwork.plans.descriptions import refresh_descriptions, refresh_notes
from duskwork.plans.intake import take_in
from duskwork.plans.job import JobResult, chain, next_state, run_job
from duskwork.plans.mailbox import mail_annual_report, purge_mailboxes
from duskwork.plans.night import HOUSEKEEPING_NIGHT, INTAKE_NIGHT, NightStopped, Step, report, run_night
from duskwork.plans.refresh import refresh_accounts, refresh_users
from duskwork.plans.settlement import settle_transactions
from duskwork.plans.users import queue_password_resets, set_dormant

# Log name of a failure, and the job.
JOBS = {
    "DelExpTrnReqWOApp": expire_approvals,
    "DeleteMailbox": purge_mailboxes,
    "AlertByFund": alert_by_fund,
    "AlertByPlanAccount": alert_by_account,
    "HkpTrnHist": archive_transactions,
    "DormantUserID": set_dormant,
    "NewCustomerRecord": take_in,
    "GenPwdForFrontEnd": queue_password_resets,
    "TransactionApproval": settle_transactions,
    "AnnualReport": mail_annual_report,
    "RefreshExpNotes": refresh_notes,
    "TrxDescription": refresh_descriptions,
    "REFRESH PLANACCT": refresh_accounts,
    "REFRESH USR": refresh_users,
}

__all__ = [
    "HOUSEKEEPING_NIGHT", "INTAKE_NIGHT", "JOBS", "JobResult", "NightStopped", "Step", "chain", "next_state", "report", "run_job", "run_night",
    "alert_by_account", "alert_by_fund", "archive_transactions", "expire_approvals", "mail_annual_report",
    "purge_mailboxes", "queue_password_resets", "refresh_accounts", "refresh_descriptions", "refresh_notes",
    "refresh_users", "set_dormant", "settle_transactions", "take_in",
]
