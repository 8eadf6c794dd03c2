"""Alerts of failed stages: every channel is tried on its own, and the log has what no channel took."""

from __future__ import annotations

import json
import logging
import smtplib
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from email.message import EmailMessage

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Alert:
    run_id: str
    stage: str
    error: str
    records: int = 0
    more: dict[str, object] = field(default_factory=dict)

    def text(self) -> str:
        rows = {"run": self.run_id, "stage": self.stage, "records": self.records, "error": self.error} | self.more
        return "A stage has failed\n" + "\n".join(f"{k}: {v}" for k, v in rows.items())


Channel = Callable[[Alert], None]


def webhook(url: str, post: Callable[[str, bytes], int] | None = None) -> Channel:
    """Posts {"text": …}; any status but 200 and 204 is an error."""

    def posted(to: str, body: bytes) -> int:
        request = urllib.request.Request(to, body, {"Content-Type": "application/json"}, method="POST")
        with urllib.request.urlopen(request, timeout=10) as answer:
            return answer.status

    def send(alert: Alert) -> None:
        status = (post or posted)(url, json.dumps({"text": alert.text()}).encode())
        if status not in (200, 204):
            raise OSError(f"the webhook answered {status}")

    return send


def mail(host: str, to: str, sender: str, port: int = 25, connect: Callable = smtplib.SMTP) -> Channel:
    def send(alert: Alert) -> None:
        message = EmailMessage()
        message["Subject"], message["From"], message["To"] = f"Stage {alert.stage} failed in run {alert.run_id}", sender, to
        message.set_content(alert.text())
        with connect(host, port, timeout=10) as server:
            server.send_message(message)

    return send


def channels(environment: Mapping[str, str]) -> dict[str, Channel]:
    """Those that the environment names: ALERT_WEBHOOK_URL; SMTP_HOST with ALERT_EMAIL_TO, and SMTP_FROM and SMTP_PORT if set."""
    out: dict[str, Channel] = {}
    if url := environment.get("ALERT_WEBHOOK_URL"):
        out["webhook"] = webhook(url)
    if (host := environment.get("SMTP_HOST")) and (to := environment.get("ALERT_EMAIL_TO")):
        out["mail"] = mail(host, to, environment.get("SMTP_FROM", "factloom@localhost"), int(environment.get("SMTP_PORT", "25")))
    return out


def dispatch(alert: Alert, to: Mapping[str, Channel]) -> list[str]:
    """The channels that took the alert; one that fails doesn't keep it from the next."""
    took = []
    for name, send in to.items():
        try:
            send(alert)
            took.append(name)
        except Exception as e:  # noqa: BLE001  whatever a channel raises
            log.error("alert by %s failed: %s", name, e)
    if not took:
        log.error("no channel took this alert: %s", alert.text())
    return took


def first_failed(audit: list[dict]) -> str:
    """The stage that failed first in a run's audit rows; "unknown" if none did."""
    return next((r["stage"] for r in audit if r["status"] == "failed"), "unknown")
