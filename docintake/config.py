"""Zone names and limits of an intake store."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class IntakeConfig:
    root: str = "/"
    ingress: str = "ingress"
    local: str = "local"
    remote: str = "remote"
    remote_ingress: str = "remote-ingress"
    archive: str = "archive"
    derivatives: str = "derivatives"
    consumer: str = "intake"
    version: str = "1"
    verify_timeout: int = 10
    # seconds in which one document is not run again; None switches the check off
    recent_tolerance: int | None = 10
    max_requests: int = 20
    max_retries: int = 3
    keep_prior_origins: bool = False

    @property
    def root_slash(self) -> str:
        return self.root.rstrip("/") + "/"


DEFAULT = IntakeConfig()

# URI schemes that can be fetched.
HTTP_SCHEMES = ("http", "https")
FTP_SCHEMES = ("ftp", "ftps", "sftp")
REMOTE_SCHEMES = HTTP_SCHEMES + FTP_SCHEMES

# Fixed value: MD5 of no bytes at all.
EMPTY_MD5 = "d41d8cd98f00b204e9800998ecf8427e"
